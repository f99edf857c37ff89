"""Training-data pipeline operators (licence scan, token files, sharding,
repeated-passage removal, language id, mixing, top-k search, quality,
decontamination, near-duplicate removal).

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds its
queries when it is present.
"""
