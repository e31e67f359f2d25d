from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
import corpus_pipeline
from corpus_texts import prose
from posloom.llm import queries, toxicity
from test_dedup import classes, normal

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.TWIN_SQL))
def test_query_equals_its_twin(spark, name):
    db = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    df = queries.QUERIES[name](spark, DATA)
    twin = db.sql(queries.TWIN_SQL[name])
    assert sorted(df.columns) == sorted(twin.columns)
    mine = sorted(map(str, df.select(*twin.columns).collect()))
    columns = twin.columns
    other = sorted("Row(" + ", ".join(f"{c}={v!r}" for c, v in zip(columns, row)) + ")" for row in twin.fetchall())
    assert mine == other


def test_every_operator_is_registered():
    names = list(entry_points.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert "pipeline" in names


def test_stages_keep_columns_and_pass_on_their_decisions(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DATA)
        path = str(tmp_path / name)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        if name != "packing":
            assert docs.columns == columns
            assert 0 < docs.count() <= before
            before = docs.count()
    assert docs.select("doc_id").distinct().count() == before


def test_run_equals_its_stages(spark):
    assert corpus_pipeline.run(spark, DATA).count() > 0


def plain_run(rows, model):
    """The stages in plain Python: rows kept by each, given the learned lexicon and curve."""
    matcher = toxicity.Matcher(model.lexicon)

    def score(text):
        words, hits, weight = matcher.hits(text)
        size = max(words, 1)
        z = np.dot(model.curve, [1, math.log1p(weight), math.log1p(100 * weight / size), math.log1p(hits), (hits > 0) * math.log(size)])
        return 1 / (1 + math.exp(-min(max(z, -30), 30)))

    kept = [r for r in rows if score(r["text"]) < toxicity.THRESHOLD]
    sizes = [len(kept)]
    first = {}
    for r in sorted(kept, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0)):
        first.setdefault(normal(r["text"]), r)
    kept = list(first.values())
    sizes.append(len(kept))
    groups = defaultdict(list)
    for r, c in zip(kept, classes([r["text"] for r in kept])):
        groups[c].append(r)
    kept = [min(g, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0)) for g in groups.values()]
    sizes.append(len(kept))
    return kept, sizes


def test_run_equals_plain_python(spark, tmp_path):
    """Toxic rows, copies and near copies go and no other; the mix keeps whole documents up to each leaf's
    budget; every token of what it keeps is packed once."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows, labels = [], []
    for n in range(360):
        words = prose(7000 + n, 30 + 7 * (n % 30)).split()
        if n % 6 == 0:
            words[3::9] = ["nastyword"] * len(words[3::9])
        rows.append({"doc_id": n, "text": " ".join(words), "lang": ["en", "de", None][n % 3], "source": ["src0", "src1", "plain"][n // 3 % 3], "n_chars": 1})
        if n % 5:
            labels.append((n, 1, int(n % 6 == 0)))
    for n in range(1, 60, 2):
        rows.append(rows[n] | {"doc_id": 1000 + n, "text": rows[n]["text"].replace(" ", "  ", 3)})
        changed = rows[n + 60]["text"].split()
        if n % 6 and len(changed) > 150:
            changed[-1] = "changed"
            rows.append(rows[n + 60] | {"doc_id": 2000 + n, "text": " ".join(changed)})
    rows += [{"doc_id": 3000, "text": None, "lang": None, "source": None, "n_chars": None}, {"doc_id": 3001, "text": "", "lang": "en", "source": "src0", "n_chars": 0}]
    spec = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([tuple(r.values()) for r in rows], spec).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    model = toxicity.train(docs, spark.read.parquet(str(tmp_path / "labels.parquet")))
    kept, sizes = plain_run(rows, model)
    assert sizes[0] < len(rows) and sizes[0] > sizes[1] > sizes[2]

    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = {r["doc_id"] for r in got}
    by_id = {r["doc_id"]: r for r in kept}
    assert ids <= by_id.keys()
    # The mix: of each leaf the shortest prefix of its order that reaches its budget.
    count = lambda r: len((r["text"] or "").split())
    total = sum(map(count, kept))
    left_out = [by_id[i] for i in by_id.keys() - ids]
    longest = sum(max(count(r) for r in kept if (r["lang"], r["source"]) == leaf) for leaf in {(r["lang"], r["source"]) for r in kept})
    taken = sum(count(by_id[i]) for i in ids)
    assert left_out and 0.9 * total - 20 <= taken <= 0.9 * total + longest
    # Packing: all pieces of these documents, once each, gapless.
    want = Counter()
    for i in ids:
        tokens = np.asarray([*tokenizer.encode(by_id[i]["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        want[i, 0, 0, len(tokens), zlib.crc32(tokens.tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    places = defaultdict(list)
    for r in got:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for spots in places.values():
        ends = [0, *[a + b for a, b in sorted(spots)]]
        assert [a for a, _ in sorted(spots)] == ends[:-1] and ends[-1] <= 2048


def test_run_on_edge_and_empty_tables(spark, edge, nothing, labels, tmp_path):
    for name, table in (("edge", edge), ("nothing", nothing)):
        folder = tmp_path / name
        table.write.parquet(str(folder / "documents.parquet"))
        labels.filter("toxic = 0").write.parquet(str(folder / "labels.parquet"))  # no text is toxic then
        got = corpus_pipeline.run(spark, str(folder)).collect()
        assert (len(got) > 0) == (name == "edge")
        assert len({(r["sequence_id"], r["offset"]) for r in got}) == len(got)
