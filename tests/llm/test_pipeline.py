"""Every stage of the pipeline against a plain version on its own input."""

import collections

import pytest

import __spark_entry__
import corpus_pipeline
from tests.llm import plain
from textsignal.llm import language, mixing, sharding
from textsignal.llm.store import stored

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    """The documents before and after each stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tables = [docs]
    for _, stage in corpus_pipeline.STAGES:
        tables.append(stored(stage(spark, tables[-1], SF)))
    return [[r.asDict() for r in t.orderBy("doc_id", "text").collect()] for t in tables]


def test_stages_and_columns(kept):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language", "near_duplicates", "decontamination", "mixing", "sharding",
    ]
    columns = list(kept[0][0])
    assert all(list(t[0]) == columns for t in kept[:-1])
    assert list(kept[-1][0]) == [*columns, "slot", "shard"]


def test_language_stage(spark, kept):
    before, after = kept[0], kept[1]
    letters = [r for r in before if any(c.isalpha() for c in r["text"] or "")]
    assert len(after) >= 0.99 * len(letters) and all(r in letters for r in after)


def test_near_duplicate_stage(kept):
    before, after = kept[1], kept[2]
    of = plain.components([r["text"] for r in before])
    first = {}
    for row, component in zip(before, of):
        if plain.shingles(row["text"]):
            first.setdefault(component, row)
    alone = [r for r in before if not plain.shingles(r["text"])]
    wanted = sorted([*first.values(), *alone], key=lambda r: r["doc_id"])
    assert after == wanted


def test_decontamination_stage(spark, kept):
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before, after = kept[2], kept[3]
    grams = {tuple(plain.tokens(t)[i : i + 3]) for t in items for i in range(len(plain.tokens(t)) - 2)}
    wanted = []
    for row in before:
        said = plain.tokens(row["text"])
        # Eleven words of thirteen in common leave three in a row in common.
        near = any(tuple(said[i : i + 3]) in grams for i in range(len(said) - 2))
        if not near or not plain.overlaps([row["text"]], items):
            wanted.append(row)
    assert after == wanted


def test_mixing_stage(kept):
    before, after = kept[3], kept[4]
    rows = [(r["doc_id"], len((r["text"] or "").split()), r["source"]) for r in before]
    _, target = plain.mix(rows)
    taken, copies = collections.Counter(), collections.Counter()
    own = {r["doc_id"]: r for r in before}
    for r in after:
        taken[r["source"]] += len(r["text"].split())
        copies[r["doc_id"]] += 1
        assert own[r["doc_id"]]["text"].startswith(r["text"])
    assert {s: int(t + 1e-6) for s, t in target.items()} == dict(taken)
    assert max(copies.values()) <= mixing.LIMIT


def test_sharding_stage(kept):
    before, after = kept[4], kept[5]
    assert [{k: v for k, v in r.items() if k not in ("slot", "shard")} for r in after] == before
    size = sharding.table_size(sharding.SHARDS)
    owner = sharding.lookup_table([f"shard-{i}" for i in range(sharding.SHARDS)], size)
    assert all(owner[r["slot"]] == r["shard"] for r in after)


def test_pipeline_query_is_the_stages(spark, kept):
    assert __spark_entry__.queries()["pipeline"](spark, SF).count() == len(kept[-1])


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF))
        assert docs.count() == 0


def test_every_operator_has_a_query():
    names = __spark_entry__.queries()
    for n in range(1, 11):
        assert any(name.startswith(f"op{n}_") for name in names)


def test_language_model_is_bounded():
    assert language.DIMS * language.CLUSTERS <= 1 << 16
