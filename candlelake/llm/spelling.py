"""Spelling variants of a corpus's words, by asymmetric q-chunks.

Two words are near if one code point inserted, deleted or replaced makes one of the other. The shorter word of a pair (of
equally long ones the smaller) contributes two disjoint chunks, its first half and the half after that; the other one its
positional grams of that length. One edit touches one of the chunks at most, so the other one is a gram of the longer word,
at most one place further on: chunks and grams are joined within a shift of one, and the edit distance is checked within
that join, so that it makes no row but pairs of near words.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, texts

LETTERS = r"A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A form has at least so many times its variant's occurrences.
RATIO = 5


def misspell(doc_id: Column, run: Column, every: int) -> Column:
    """The run without one code point, if every divides the crc32 of ``<doc_id>:<run>``: that modulo the length, from 0.
    A run of a document without an id stays."""
    h = F.crc32(F.concat(doc_id.cast("string"), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % every == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def vocabulary(docs: DataFrame, min_length: int = 6, min_count: int = 5, misspell_every: int | None = None) -> DataFrame:
    """word, n: maximal runs of Latin letters, A-Z in lower case, of min_length code points or more that occur min_count times
    or more. With misspell_every, one run in so many loses a code point first (see ``misspell``)."""
    runs = texts(docs).select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0))).alias("run"))
    runs = runs.select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))
    words = runs.select((misspell(F.col("doc_id"), F.col("run"), misspell_every) if misspell_every else F.col("run")).alias("word"))
    return words.where(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def near_pairs(words: DataFrame) -> DataFrame:
    """short, short_n, long, long_n: every pair of words of which one edit makes one of the other, once. words: word, n."""
    half = F.expr("chunk_length div 2")
    one = words.select("word", "n", F.length("word").alias("chunk_length"))
    chunks = one.select(F.col("word").alias("short"), F.col("n").alias("short_n"), "chunk_length", half.alias("q"),
                        F.explode(F.array(F.lit(0), half)).alias("chunk_at"))
    chunks = chunks.withColumn("gram", F.substring("short", F.col("chunk_at") + 1, F.col("q"))).drop("q")
    # The longer word meets chunks of words as long as itself and of words one shorter; grams that no chunk's place is within
    # one of are left out at once.
    other = words.select("word", "n", F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("chunk_length")).withColumn("q", half)
    grams = other.where("q > 0").select("word", "n", "chunk_length", "q", F.explode(F.sequence(F.lit(0), F.length("word") - F.col("q"))).alias("gram_at"))
    grams = grams.where((F.col("gram_at") <= 1) | (F.abs(F.col("gram_at") - F.col("q")) <= 1))
    grams = grams.select(F.col("word").alias("long"), F.col("n").alias("long_n"), F.col("chunk_length").alias("gram_length"), "gram_at",
                         F.substring("word", F.col("gram_at") + 1, F.col("q")).alias("long_gram"))
    met = (F.col("gram") == F.col("long_gram")) & (F.col("chunk_length") == F.col("gram_length")) & (F.abs(F.col("gram_at") - F.col("chunk_at")) <= 1)
    once = (F.length("long") > F.col("chunk_length")) | (F.col("short") < F.col("long"))
    near = F.levenshtein("short", "long", 1) == 1
    return chunks.join(grams, met & once & near).select("short", "short_n", "long", "long_n").distinct()


def spelling_variants(docs: DataFrame, min_length: int = 6, min_count: int = 5, misspell_every: int | None = None) -> DataFrame:
    """word, form, root, n, n_near, form_n: each word of ``vocabulary`` with the number of its near words and its form, the
    near word with most occurrences (ties: smallest in code-point order), if these are RATIO times its own or more, else
    null; root is where forms lead at last, the word itself if it has none.

    Null and empty texts have no words; documents that repeat an id count each; columns other than doc_id and text are
    ignored; an empty table has no rows.
    """
    words = materialise(vocabulary(docs, min_length, min_count, misspell_every))
    pairs = near_pairs(words)
    sides = pairs.select(F.col("short").alias("word"), F.col("long").alias("other"), F.col("long_n").alias("other_n")).unionByName(
        pairs.select(F.col("long").alias("word"), F.col("short").alias("other"), F.col("short_n").alias("other_n")))
    best = sides.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("minus"), "other")).alias("best"))
    common = -F.col("best.minus") >= RATIO * F.col("n")
    found = materialise(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(common, F.col("best.other")).alias("form"), F.when(common, -F.col("best.minus")).alias("form_n")))
    return found.join(_roots(found), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(found: DataFrame) -> DataFrame:
    """word, root of the words that have a form. Every step up multiplies the occurrences by RATIO or more, so the most
    frequent form bounds the number of steps; each round doubles the steps that a row has gone."""
    up = found.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    most, least = found.where("form IS NOT NULL").agg(F.max("form_n"), F.min("n")).first()
    steps = 1 if most is None else max(1, math.floor(math.log(most / least, RATIO) + 1e-9))
    for _ in range(math.ceil(math.log2(steps))):
        up = materialise(up)
        on = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        up = up.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return up


#: Near words by deleted and replaced code points one by one, crc32 from its definition.
ORACLE = r"""
WITH RECURSIVE tab AS MATERIALIZED (
       SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, (c & 1) * 3988292384))) AS t),
     runs AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS r FROM documents),
     runs2 AS MATERIALIZED (SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r, count(*) AS c FROM runs WHERE length(r) >= 6 GROUP BY ALL),
     bytes AS (SELECT doc_id, r, c, t, flatten(list_transform(string_split(concat(doc_id::VARCHAR, ':', r), ''), lambda x:
         CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [(192 | (unicode(x) >> 6))::BIGINT, (128 | (unicode(x) & 63))::BIGINT] END)) AS b FROM runs2, tab),
     h AS (SELECT r, c, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda s, x: xor(t[xor(s, x) % 256 + 1], s >> 8)), 4294967295) AS h FROM bytes),
     w AS (SELECT CASE WHEN h % 199 = 0 THEN concat(left(r, (h % length(r))::INT), substr(r, (h % length(r))::INT + 2)) ELSE r END AS word, c FROM h),
     v AS MATERIALIZED (SELECT word, sum(c)::BIGINT AS n FROM w WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
     places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
     cut AS (SELECT word, n, i, concat(left(word, i - 1), substr(word, i + 1)) AS d FROM places),
     near AS (SELECT DISTINCT a.word AS a, a.n AS an, b.word AS b, b.n AS bn FROM cut a JOIN cut b ON a.d = b.d AND a.i = b.i AND a.word <> b.word
              UNION SELECT cut.word, cut.n, v.word, v.n FROM cut JOIN v ON cut.d = v.word UNION SELECT v.word, v.n, cut.word, cut.n FROM cut JOIN v ON cut.d = v.word),
     best AS (SELECT a, count(*) AS n_near, first(b ORDER BY bn DESC, b) AS b, max(bn) AS bn FROM near GROUP BY a),
     f AS MATERIALIZED (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN bn >= 5 * n THEN b END AS form, CASE WHEN bn >= 5 * n THEN bn END AS form_n FROM v LEFT JOIN best ON word = a),
     up AS (SELECT word, form AS last, 1 AS steps FROM f WHERE form IS NOT NULL UNION ALL SELECT up.word, f.form, steps + 1 FROM up JOIN f ON up.last = f.word WHERE f.form IS NOT NULL),
     root AS (SELECT word, max_by(last, steps) AS root FROM up GROUP BY word)
SELECT f.word, form, coalesce(root, f.word) AS root, n, n_near, form_n FROM f LEFT JOIN root ON root.word = f.word
"""
