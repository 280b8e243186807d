r"""Secret scan with multipart credential linking.

Base findings are reported wherever they are. Beyond them, parts that prove little alone are reported only when a part
that complements them lies in the same scope (a distance of ``scope`` code points): access identifiers and user names,
opaque secret strings, and endpoints. Parts of the corpus are a table of intervals; linking is an interval semi-join on
(row, scope-wide bucket) against the outermost parts of each kind in a bucket, so that no pair of parts is ever made.
All of it is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, texts

#: kind: (pattern, least length, group the length is of). Base kinds, in the order that breaks ties.
BASE = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    "access": (r"AKIA[A-Z0-9]+", 20, 0),
    "hex": (r"[0-9a-f]+", 24, 0),
}
#: kind: (pattern, least length, kinds one of which must be near).
WEAK = {
    "ident": (r"""(?i)(?:access_?key_?id|client_?id|account_?id|user_?name|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}""", 3, ("opaque", "assign", "hex")),
    "opaque": (r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/]*[0-9])(?=[A-Za-z0-9+/]*[a-z])(?=[A-Za-z0-9+/]*[A-Z])[A-Za-z0-9+/]{32,}+={0,2}(?![A-Za-z0-9+/=_-])", 32, ("ident", "access", "endpoint")),
    "endpoint": (r"(?i)(?:https?|postgres(?:ql)?|mysql|mongodb|redis|amqps?|s3)://[A-Za-z0-9._~:@/?&=%-]{4,}", 9, ("ident", "access", "opaque", "assign")),
}
KINDS = [*BASE, *WEAK]


#: Matches that are placed at once. An array that is built up is copied at every step, so long ones are built in parts.
PART = 256


def _bound(value: Column, use) -> Column:
    """use(value), where the value is worked out once although lambdas inside refer to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _placed(steps: Column) -> Column:
    """Array of (start, end, size), of steps (gap before a match, its length, size) one after the other."""
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,size:int>>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        start = s["at"] + x["gap"]
        end = start + x["length"]
        return F.struct(end.alias("at"), F.concat(s["out"], F.array(F.struct(start.alias("start"), end.alias("end"), x["size"].alias("size")))).alias("out"))

    def parts(own: Column) -> Column:
        count = F.floor((F.size(own) - 1) / PART).cast("int")
        return F.transform(F.sequence(F.lit(0), count), lambda k: F.aggregate(F.slice(own, k * PART + 1, F.lit(PART)), state, step))

    def joined(found: Column) -> Column:
        bases = F.aggregate(found, F.array(F.lit(0)), lambda s, x: F.concat(s, F.array(F.element_at(s, -1) + x["at"])))
        return F.flatten(F.zip_with(found, F.slice(bases, 1, F.size(found)), lambda x, base: F.transform(x["out"], lambda o: F.struct((o["start"] + base).alias("start"), (o["end"] + base).alias("end"), o["size"].alias("size")))))

    return _bound(_bound(steps, parts), joined)


def matches(text: Column, pattern: str, least: int, group: int) -> Column:
    """Array of (start, end, size) in code points of the leftmost, non-overlapping matches whose group is long enough."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    # What lies between the matches gives the places: the k-th match follows k + 1 of those pieces and k matches.
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    sizes = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.length) if group else F.transform(whole, F.length)
    found = F.zip_with(F.transform(whole, F.length), sizes, lambda length, size: F.struct(length.alias("length"), size.alias("size")))
    # The piece after the last match has none; a match can't be empty.
    steps = F.filter(F.zip_with(gaps, found, lambda gap, m: F.struct(gap.alias("gap"), m["length"].alias("length"), m["size"].alias("size"))), lambda x: x["length"].isNotNull())
    none = F.array().cast("array<struct<start:int,end:int,size:int>>")
    return F.when(F.exists(sizes, lambda n: n >= least), F.filter(_placed(steps), lambda m: m["size"] >= least)).otherwise(none)


def scan(docs: DataFrame) -> DataFrame:
    """row, doc_id and for each kind an array of (start, end): one pass over the texts."""
    # Runs that are too short to count may be left out of the match: a run is maximal from its first character on.
    base = {"assign": BASE["assign"], "access": (r"AKIA[A-Z0-9]{16,}", 20, 0), "hex": (r"[0-9a-f]{24,}", 24, 0)}
    every = base | {k: (pattern, least, 0) for k, (pattern, least, _) in WEAK.items()}
    return texts(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id", *[matches(F.col("text"), *every[k]).alias(k) for k in KINDS])


def _tagged(kind: str, *fields: str) -> Column:
    """The spans of a kind, as structs of the fields asked for: its place in KINDS, start and end."""
    return F.transform(kind, lambda x: F.struct(*[(F.lit(KINDS.index(kind)) if f == "kind" else x[f]).alias(f) for f in fields]))


def _parts(found: DataFrame) -> DataFrame:
    """row, kind (its place in KINDS), start, end: one row for each part of a document that has a weak one."""
    kinds = F.concat(*[_tagged(k, "kind", "start", "end") for k in KINDS])
    some = F.lit(False)
    for k in WEAK:
        some = some | (F.size(k) > 0)
    return found.where(some).select("row", F.explode(kinds).alias("p")).select("row", "p.kind", "p.start", "p.end")


def linked_parts(found: DataFrame, scope: int = 400) -> DataFrame:
    """The weak parts with a complement at most ``scope`` code points away: row, kind, start, end."""
    parts = _parts(found)
    bucket = lambda x: F.floor(x / scope).cast("long")
    # A part is filed in every bucket that it touches; of each kind and bucket only the first start and last end matter.
    filed = parts.select("row", F.col("kind").alias("other"), "start", "end", F.explode(F.sequence(bucket(F.col("start")), bucket(F.col("end")))).alias("bucket"))
    filed = filed.groupBy("row", "bucket", "other").agg(F.min("start").alias("first"), F.max("end").alias("last"), F.max("start").alias("last_start"), F.min("end").alias("first_end"))
    asks = F.array(*[F.array(*[F.lit(KINDS.index(o)) for o in WEAK[k][2]]) for k in WEAK])
    weak = parts.where(F.col("kind") >= len(BASE)).withColumn("other", F.explode(F.get(asks, F.col("kind") - len(BASE))))
    weak = weak.withColumn("bucket", F.explode(F.sequence(bucket(F.greatest(F.col("start") - scope, F.lit(0))), bucket(F.col("end") + scope))))
    # Some part of that kind touches the bucket; it is near if the outermost of those there are.
    near = (F.col("first") <= F.col("end") + scope) & (F.col("last") >= F.col("start") - scope)
    return weak.join(filed, ["row", "bucket", "other"]).where(near).select("row", "kind", "start", "end").distinct()


def _joined(spans: Column) -> Column:
    """kind:start:end, comma-joined, of an array of (start, kind, end) in order."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def secret_scan(docs: DataFrame, scope: int = 400) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked.

    Null counts as an empty text; an empty text has no spans, and the digest of no spans is that of the empty string. Rows
    that repeat a doc_id, or have none, are judged one by one; texts of any length are read whole. Of spans that start
    together, kinds come in the order of KINDS. An empty table gives an empty result; extra columns are ignored, whatever
    their names.
    """
    found = materialise(scan(docs))
    linked = linked_parts(found, scope).groupBy("row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("linked"))
    base = F.concat(*[_tagged(k, "start", "kind", "end") for k in BASE])
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    rows = found.select("row", "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE], base.alias("base")).join(linked, "row", "left")
    more = F.coalesce("linked", none)
    return rows.select("doc_id", *[f"n_{k}" for k in BASE], F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                       _joined(F.concat("base", more)).alias("spans"), F.size(more).cast("long").alias("n_linked"))
