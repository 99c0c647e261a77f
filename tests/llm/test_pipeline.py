import re
from collections import defaultdict

import helpers  # noqa: F401  (puts the repository on the path)
import corpus_pipeline
from helpers import documents
import xxhash
from pyspark.sql import functions as F

from seekframe.llm import packing, pii, quality, toxicity
from seekframe.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def plain_fingerprint(text):
    """64 bits, each by the majority of the hashes of the shingles of three words."""
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    toxic, good = toxicity.learn(docs, labels), quality.learn(docs, labels)
    left = sorted(map(tuple, docs.collect()))
    left = [r for r in left if toxic.score(r[1]) < 0.3]
    left = [r for r in left if good.score(r[1]) >= 0.7]
    prints = [plain_fingerprint(r[1]) for r in left]
    root = list(range(len(left)))
    for i in range(len(left)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    left = [r for i, r in enumerate(left) if root[i] == i]
    want = set()
    for r in left:
        ids = packing._ids(corpus_pipeline.public_tokenizers.path("byte_bpe_50k.json"))(pii.redact(r[1]))
        want.add((r[0], len(ids) + 1))
    sizes = defaultdict(int)
    for r in corpus_pipeline.run(spark, FOLDER).collect():
        sizes[r.doc_id] += r.length
    assert set(sizes.items()) == want
    assert len(want) > 300


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    current = docs.withColumn("score", F.lit(1)).withColumn("fingerprint", F.lit("x"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        current = stage(spark, current, FOLDER)
        assert current.columns == [*docs.columns, "score", "fingerprint"]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near copies", "personal data", "packing"]


def test_empty_and_odd_documents(spark):
    for rows in ([], [(1, None), (None, ""), (None, None), (2, "plain words " * 30), (2, "plain words " * 30)]):
        current = documents(spark, rows)
        for _, stage in corpus_pipeline.STAGES:
            current = stage(spark, current, FOLDER)
        assert len(current.collect()) <= len(rows)


def test_all_queries_are_there():
    assert {int(n.split("_")[0][2:]) for n in QUERIES} == set(range(1, 14))
