"""The pipeline beside plain versions of its decisions, stage by stage."""

import hashlib
import re

import public_tokenizers as P
import pytest
import tiktoken

import corpus_pipeline as pipeline
from cropweave.llm import byte_bpe, personal, toxicity
from test_decontamination import plain_words
from test_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.001"
ODD = [(900_001, None), (900_002, ""), (900_002, ""), (None, "nobody has given this row a number, but its words are its own")]


@pytest.fixture
def folder(spark, tmp_path):
    """Tables as an sf folder has them: documents with odd rows and a clashing column."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame(ODD, "doc_id long, text string")
    docs = docs.unionByName(odd, allowMissingColumns=True).selectExpr("*", "doc_id % 3 AS score")
    docs.write.parquet(f"file://{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"file://{tmp_path}/{name}.parquet")
    return f"file://{tmp_path}"


def windows(words, size=10):
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}


def test_stages_are_the_five():
    assert [x for x, _ in pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "byte_bpe"]
    assert pipeline.ORACLE_SQL is None


def test_run_equals_plain_decisions(spark, folder, tmp_path):
    docs, labels, items = (spark.read.parquet(f"{folder}/{x}.parquet") for x in ("documents", "labels", "benchmark"))
    store = f"file://{tmp_path}/plain"
    scored = toxicity.toxicity_scores(docs, labels, store).select("doc_id", "score").collect()
    toxic = {r["doc_id"] for r in scored if r["score"] >= 0.5}
    rows = {(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect() if r["doc_id"] not in toxic}
    named = sorted((d, t) for d, t in rows if d is not None and d < 900_000)
    roots = plain_components([(d, plain_fingerprint(t)) for d, t in named], 4)
    one = [(d, t) for d, t in named if roots[d] == d] + [ODD[0], ODD[3]]
    phrases = [plain_words(r["text"]) for r in items.select("text").collect()]
    known = set().union(*(windows(x) for x in phrases if len(x) >= 10))
    short = [x for x in phrases if 0 < len(x) < 10]
    clean = []
    for doc, text in one:
        words = plain_words(text)
        if not windows(words) & known and not any(tuple(x) in windows(words, len(x)) for x in short):
            clean.append((doc, text))
    assert 0 < len(clean) < len(one) < len(rows)

    left = spark.createDataFrame(clean, "doc_id long, text string")
    spans = {r["doc_id"]: r["spans"] for r in personal.personal_data(left, store).select("doc_id", "spans").collect()}
    ranks = byte_bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for doc, text in clean:
        text = text or ""
        parts = sorted((int(a), int(b), kind) for kind, a, b in (x.split(":") for x in spans[doc].split(",") if x))
        for a, b, kind in reversed(parts):
            text = f"{text[:a]}[{kind.upper()}]{text[b:]}"
        ids = library.encode_ordinary(text)
        want.append((doc, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    got = [tuple(r) for r in pipeline.run(spark, folder).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert any(re.search(r"\w", x) for x in spans.values())


def test_stages_keep_the_columns_and_take_empty_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for table in (docs, docs.limit(0)):
        for _, stage in pipeline.STAGES[:-1]:
            out = stage(spark, table, folder)
            assert out.columns == docs.columns
            if table is not docs:
                assert out.count() == 0
    assert pipeline.STAGES[-1][1](spark, docs.limit(0), folder).count() == 0
