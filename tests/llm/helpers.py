"""Fixtures and brute-force versions for the operators' tests."""
import hashlib
import re

from pyspark.sql import types as T

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"

#: columns that clash with names the operators use inside
CLASHING = ["rid", "size", "shard", "score", "label", "name", "at", "rank", "key", "cell", "bucket", "u", "v", "nth",
            "component", "path", "term", "w", "taken", "target", "rows", "same", "_id", "_doc", "g", "arc"]


def docs_of(spark, rows, extra=True):
    """rows of (doc_id, text[, lang, source]) as a documents table."""
    fields = [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
              T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
              T.StructField("n_chars", T.LongType())]
    data = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "src0", len(r[1] or "")) for r in rows]
    if extra:
        fields += [T.StructField(c, T.StringType()) for c in CLASHING]
        data = [d + tuple("x" for _ in CLASHING) for d in data]
    return spark.createDataFrame(data, T.StructType(fields))


LONG = "The quick brown fox jumps over the lazy dog number %d. "

ODD = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "word"), (5, "one two three four"), (6, "one two three four five six"),
    (7, "one two three four five six"), (7, "one two three four five six"), (8, "été 你好 \U0001f600 x"), (9, "123 456 !!"),
    (None, "no id here but some words to count"), (10, "".join(LONG % i for i in range(20_000)), None, None),
    (11, "".join(LONG % i for i in range(20_000)), "en", None), (12, "a" * 300_000), (13, "\x00\x01   odd\x1cspace"),
    (14, "Same text in two sources.", None, "src1"), (15, "Same text in two sources.", "de", "src2"),
]


def texts(sf_dir):
    import duckdb
    return duckdb.sql(f"SELECT doc_id, text FROM read_parquet('{sf_dir}/documents.parquet') ORDER BY 1").fetchall()


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def shingles(text):
    w = [x.translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))) for x in words(text)]
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < 5 else frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def near_duplicate_classes(rows):
    """{doc_id: (set size, smallest reachable id)} by comparing all pairs."""
    sets = {d: shingles(t) for d, t in rows}
    root = {d: d for d in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    ids = sorted(sets)
    where = {}
    for d in ids:
        for s in sets[d]:
            where.setdefault(s, []).append(d)
    for d in ids:
        shared = {}
        for s in sets[d]:
            for e in where[s]:
                if e < d:
                    shared[e] = shared.get(e, 0) + 1
        for e, n in shared.items():
            if 100 * n >= 75 * (len(sets[d]) + len(sets[e]) - n):
                a, b = find(d), find(e)
                root[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), find(d)) for d in ids}


def repeats_removed(rows, length=100):
    """{doc_id: (bytes, removed, spans, sha256 of the rest)}, ids ascending."""
    seen, out = set(), {}
    for d, t in sorted(rows):
        b = (t or "").encode()
        gone = [False] * len(b)
        until = 0
        for i in range(len(b)):
            if i + length <= len(b):
                s = b[i:i + length]
                if s in seen:
                    until = i + length
                seen.add(s)
            gone[i] = i < until
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest())
    return out


def edit_distance_inside(item, text):
    """Smallest edit distance of ``item`` to any stretch of ``text``."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(text, 1):
            last, row[j] = row[j], min(last + (a != b), row[j] + 1, row[j - 1] + 1)
    return min(row)
