"""The pipeline's stages against brute force on a small table."""

import random
import tempfile

import public_tokenizers

import corpus_pipeline
from pricelens.llm import bpe
from tests.llm.test_texts import docs


def test_pipeline_equals_brute_force(spark):
    rng = random.Random(1)
    vocab = ["".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(3, 9))) for _ in range(900)]
    prose = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    item = prose(25)
    clean = [prose(120) for _ in range(12)]
    near = clean[0].split()
    near[60] = "changed"
    texts = [*clean, " ".join(near), clean[3], prose(60) + " " + item.upper() + ", " + prose(40), prose(80) + " write to a.b@mail.example.com now", "too short", None, "again and again " * 60]
    folder = tempfile.mkdtemp()
    docs(spark, texts).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert sorted(out) == [*range(12), 15]
    enc = bpe.encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    for i, r in out.items():
        want = texts[i].replace("a.b@mail.example.com", "[EMAIL]")
        assert r["exact"] and list(r["token_ids"]) == enc.encode_ordinary(want) and r["n_tokens"] == len(r["token_ids"])
    step = spark.read.parquet(f"{folder}/documents.parquet")
    columns = step.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        step = stage(spark, step, folder)
        assert step.columns == columns, name


def test_pipeline_of_nothing(spark):
    folder = tempfile.mkdtemp()
    docs(spark, []).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_pipeline_with_null_and_repeated_ids(spark):
    rng = random.Random(2)
    prose = lambda n: " ".join("".join(rng.choice("abcdefghijklm") for _ in range(6)) for _ in range(n))
    a, b, c, d = (prose(90) for _ in range(4))
    folder = tempfile.mkdtemp()
    docs(spark, [a, b, b, c, d, a, None], ids=[1, 1, 1, None, None, 5, None]).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(None, None), (3, "nothing of this is there")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    enc = bpe.encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    out = sorted(((r["doc_id"], enc.decode(list(r["token_ids"]))) for r in corpus_pipeline.run(spark, folder).collect()), key=str)
    assert out == sorted([(1, a), (1, b), (None, c), (None, d)], key=str)
