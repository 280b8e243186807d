"""Training-data operators: classification, extraction, deduplication, decontamination and packing of text tables.

Nothing else in the library imports this subpackage. Each module holds one operator with a general interface; the module
``queries`` binds the operators to the driver's tables.
"""
