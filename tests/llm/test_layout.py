"""Shards, packing, archives and the pipeline."""

import hashlib
import itertools
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from corpusq.llm import decontaminate, kdtree, near_duplicates, packing, tokens, warc
from corpusq.llm.queries import QUERIES
from corpusq.llm.texts import read_table

SF = "/root/testdata/sf0.001"


def test_kd_shards(spark, documents):
    found = QUERIES["op3_kd_tree"](spark, SF).toPandas()
    assert list(found.columns) == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    raw = {r.doc_id: r.text.encode() for r in documents.collect()}
    assert sorted(found.doc_id) == sorted(raw)
    assert all(r.size == len(raw[r.doc_id]) + 1 and r.text_crc32 == zlib.crc32(raw[r.doc_id]) for r in found.itertuples())
    sizes = found.groupby("shard")["size"].sum()
    assert list(sizes.index) == list(range(8))
    # No cut is off by more than half of the largest document on its side.
    assert (sizes - sizes.mean()).abs().max() <= 2 * found["size"].max()
    for _, part in found.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))


def test_copies_stay_together_unless_they_are_too_many(spark):
    rows = [(k, f"text {k % 500} " + "w " * (k % 500 % 7), "s", "en") for k in range(2000)] + [(5000 + k, "hot text", "s", "en") for k in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    found = kdtree.kd_shards(docs, 8).toPandas()
    homes = found.groupby("text_crc32")["shard"].nunique()
    hot = zlib.crc32(b"hot text")
    assert homes[hot] > 1 and (homes.drop(hot) == 1).all()
    sizes = found.groupby("shard")["size"].sum()
    assert sizes.max() <= 1.03 * sizes.min()


@pytest.mark.parametrize("shards", [1, 3])
def test_odd_shards(odd, none, shards):
    found = kdtree.kd_shards(odd, shards).toPandas()
    assert len(found) == odd.count() and set(found.shard) <= set(range(shards))
    for _, part in found.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    assert kdtree.kd_shards(none, shards).count() == 0


def test_kd_shards_stay_in_the_jvm(odd):
    plan = kdtree.kd_shards(odd, 4)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_ids_are_the_tokenizers(documents):
    encoder, plain = tokens.WordTokens(tokens.default_tokenizer()), Tokenizer.from_file(tokens.default_tokenizer())
    texts = [r.text for r in documents.collect()]
    texts += ["", "  a\tb ", "don't we're É́é x_y 3²µ ß İstanbul ΣΑΣ\x1cfs a<|endoftext|>b", "日本語 テスト 🎉🎉 'S n't", "áb'll.,.", " ́x", "ﬁ Å", "\r\nq\x0bz"]
    for text, raw in zip(texts, encoder.ids(texts)):
        assert np.frombuffer(raw, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_ids_of_every_latin_character_in_every_place():
    encoder, plain = tokens.WordTokens(tokens.default_tokenizer()), Tokenizer.from_file(tokens.default_tokenizer())
    texts = [word for c in map(chr, range(0x180)) for word in (c, f"{c}ab", f"a{c}b", f"ab{c}", f"ab{c}{c}", f"Ab{c}.", f"{c}1{c}", f"ab{c} cd")]
    texts += ["Fläche 12 km² und 5 m² groß", "CO² x¹ ab½ ¼ll ¾ 2³"]
    for text, raw in zip(texts, encoder.ids(texts)):
        assert np.frombuffer(raw, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_packing_query(spark, documents):
    found = QUERIES["op8_certified_packing"](spark, SF).toPandas()
    plain = Tokenizer.from_file(tokens.default_tokenizer())
    ids = {r.doc_id: plain.encode(r.text, add_special_tokens=False).ids + [0] for r in documents.collect()}
    got = defaultdict(list)
    for r in found.sort_values("piece").itertuples():
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32
        got[r.doc_id].append((r.piece, r.start, r.length))
    for doc, pieces in got.items():
        n = len(ids[doc])
        assert pieces == [(k, b, min(2048, n - b)) for k, b in enumerate(range(0, n, 2048))]
    assert got.keys() == ids.keys()
    check_bins(found, 2048)
    assert found.sequence_id.nunique() <= packing.lower_bound(found.length.to_numpy(), 2048) + 1


def check_bins(found, capacity):
    for _, part in found.groupby("sequence_id"):
        part = part.sort_values("offset")
        assert part.offset.tolist() == [0, *np.cumsum(part.length)[:-1]] and part.length.sum() <= capacity
        assert (part.sequence_fill == part.length.sum()).all()


def fewest(sizes, capacity):
    for n in range(1, len(sizes) + 1):
        for deal in itertools.product(range(n), repeat=len(sizes)):
            if all(sum(s for s, d in zip(sizes, deal) if d == b) <= capacity for b in range(n)):
                return n
    return 0


def test_bounds_never_exceed_the_best_packing():
    rng = np.random.default_rng(3)
    tight = 0
    for _ in range(60):
        sizes = rng.integers(1, 21, rng.integers(1, 7))
        best, bound = fewest(sizes.tolist(), 20), packing.lower_bound(sizes, 20)
        assert -(-sizes.sum() // 20) <= bound <= best
        assert len(packing.best_fit(sizes, 20)[2]) >= best
        tight += bound == best
    assert tight > 45
    assert packing.lower_bound(np.array([11, 11, 11]), 20) == 3  # more than their sum tells


def test_partitions_exchange_what_is_not_proven_full(spark):
    rng = np.random.default_rng(7)
    rows = [(k, int(n)) for k, n in enumerate(rng.integers(200, 700, 600))]
    pieces = spark.createDataFrame(rows, "doc_id long, length long")
    alone = packing.pack(pieces, 1000, per_partition=40, rounds=0).toPandas()
    traded = packing.pack(pieces, 1000, per_partition=40).toPandas()
    for found in (alone, traded):
        check_bins(found, 1000)
        assert Counter(zip(found.doc_id, found.length)) == Counter(rows)
        assert (found.partition_bins >= found.partition_bound).all()
    assert traded.sequence_id.nunique() < alone.sequence_id.nunique()


def test_odd_packing(spark, odd, none):
    pieces = tokens.token_pieces(odd, ["doc_id", "offset"], 2048)
    found = packing.pack(pieces, 2048).toPandas()
    check_bins(found, 2048)
    assert Counter(found[found.piece == 0].doc_id.fillna(-1)) == Counter(-1 if r.doc_id is None else r.doc_id for r in odd.collect())
    assert found[(found.doc_id == 2)].length.tolist() == [1]
    assert packing.pack(tokens.token_pieces(none, ["doc_id"], 2048), 2048).count() == 0
    with pytest.raises(Exception, match="lengths must be"):
        packing.pack(spark.createDataFrame([(1, 9)], "doc_id long, length long"), 8).collect()


@pytest.fixture
def pages(spark):
    big = "<p>" + "é" * 600
    rows = [(1, "http://a", big), (2, "http://b", big), (9, "http://c", big), (3, "u", "small"), (4, "u", "small"), (5, None, None), (6, "x\r\ny", ""), (None, "n", big), (2, "http://b", big)]
    rows += [(100 + k, "h", "\x1f\x8b\x08 WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 40 + str(np.random.default_rng(k).integers(0, 2**62, 300).tolist())) for k in range(30)]
    return spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string").repartition(2)


@pytest.mark.parametrize("split", [500, 4096, 2**20])
def test_archives_are_read_back_whole(spark, pages, split):
    manifest = warc.write_archives(pages, warc.archive_folder(spark))
    found = warc.read_archives(manifest, split).toPandas()
    assert len(found) == pages.count() == manifest.toPandas().records.sum()
    assert not found.duplicated(["archive", "member_start"]).any()
    sent = defaultdict(list)
    for r in pages.collect():
        sent[r.page_id].append((r.html or "").encode())
    kinds = Counter(zip(found.record_id.str.extract(r"page:(\d+)")[0].fillna("?"), found.record_type))
    assert kinds["1", "revisit"] == 1 and kinds["2", "revisit"] == 2 and kinds["9", "response"] == 1 and kinds["?", "response"] == 1
    assert kinds["3", "response"] == kinds["4", "response"] == 1
    for r in found.itertuples():
        page = r.record_id.removeprefix("<urn:page:").rstrip(">")
        payload = sent[int(page) if page.isdigit() else None][0]
        assert r.payload_digest == hashlib.sha1(payload).hexdigest() and r.payload_bytes == len(payload)
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == payload
        assert r.refers_to_id == ("<urn:page:9>" if r.record_type == "revisit" else None)


def test_broken_and_foreign_archives(spark, pages, tmp_path):
    manifest = warc.write_archives(pages.where("page_id < 10"), warc.archive_folder(spark))
    path = manifest.orderBy("archive").first().archive
    raw = warc._file_system(path)[0].open_input_stream(warc._file_system(path)[1], compression=None).read()
    table = lambda name, data: ((tmp_path / name).write_bytes(data), spark.createDataFrame([(str(tmp_path / name), len(data))], "archive string, bytes long"))[1]
    n = warc.read_archives(table("whole", raw), 300).count()
    noise = b"\x1f\x8b\x08" + bytes(range(256)) * 3 + zlib.compress(b"x" * 999, wbits=31)
    assert n > 0
    assert warc.read_archives(table("noise", noise + raw + noise), 300).count() == n
    assert warc.read_archives(table("none", b""), 300).count() == 0
    with pytest.raises(Exception, match="cut off"):
        warc.read_archives(table("cut", raw[:-5]), 2**20).collect()


def test_headers_of_any_length(spark, tmp_path):
    rng = np.random.default_rng(4)
    long = "data:" + rng.bytes(150_000).hex()
    pages = spark.createDataFrame([(1, "http://a", "one"), (2, long, "two"), (3, "h" * 70_000, "three")], "page_id long, url string, html string").repartition(1)
    manifest = warc.write_archives(pages, warc.archive_folder(spark))
    for split in (1000, 2**20):
        found = {r.record_id: (r.target_uri, r.payload_bytes) for r in warc.read_archives(manifest, split).collect()}
        assert found == {"<urn:page:1>": ("http://a", 3), "<urn:page:2>": (long, 3), "<urn:page:3>": ("h" * 70_000, 5)}
    (tmp_path / "endless").write_bytes(zlib.compress(b"WARC/1.1\r\nWARC-Type: response\r\n", wbits=31))
    table = spark.createDataFrame([(str(tmp_path / "endless"), (tmp_path / "endless").stat().st_size)], "archive string, bytes long")
    with pytest.raises(Exception, match="header has no end"):
        warc.read_archives(table).collect()


def test_records_are_compared_with_the_manifest(spark, pages):
    manifest = warc.write_archives(pages, warc.archive_folder(spark))
    more = manifest.withColumn("starts", F.concat("starts", F.array(F.lit(1).cast("long"))))
    with pytest.raises(Exception, match="in the manifest"):
        warc.read_archives(more, 4096).collect()


def test_no_pages(spark, pages):
    assert warc.read_archives(warc.write_archives(pages.limit(0), warc.archive_folder(spark))).count() == 0


def test_pipeline(spark):
    docs = read_table(spark, SF, "documents")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "minhash near-dedup", "benchmark decontamination", "pii", "best-fit packing"]
    labels = {r.doc_id: r.quality for r in read_table(spark, SF, "labels").collect()}
    rows, seen = docs, [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = corpus_pipeline.materialize(stage(spark, rows, SF), "test_stage")
        assert rows.columns == docs.columns
        seen.append(rows)
    ids = [{r.doc_id: r.text for r in s.collect()} for s in seen]
    gone = ids[0].keys() - ids[1].keys()
    assert gone and all(labels.get(i) != 1 for i in gone)
    classes = {r.doc_id: r.class_id for r in near_duplicates.near_duplicates(seen[1]).collect()}
    assert ids[2].keys() == set(classes.values())
    hits = {r.doc_id for r in decontaminate.contaminated(seen[2], read_table(spark, SF, "benchmark"), ["doc_id"]).collect()}
    assert ids[3].keys() == ids[2].keys() - hits and hits
    assert ids[4].keys() == ids[3].keys() and any(ids[4][i] != ids[3][i] for i in ids[4])
    assert all("@mail" not in t for t in ids[4].values())
    last = corpus_pipeline.STAGES[-1][1](spark, rows, SF).toPandas()
    assert set(last.doc_id) == set(ids[4])
    check_bins(last, 2048)
    again = corpus_pipeline.run(spark, SF).toPandas()
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(again[columns].itertuples(index=False)) == sorted(last[columns].itertuples(index=False))


def test_pipeline_of_odd_rows(spark, odd, none):
    for start, n in ((odd, odd.count()), (none, 0)):
        rows = start
        for _, stage in corpus_pipeline.STAGES[1:-1]:
            rows = corpus_pipeline.materialize(stage(spark, rows, SF), "odd_stage")
            assert rows.columns == odd.columns
        assert rows.count() == (9 if n else 0)
        assert corpus_pipeline.STAGES[-1][1](spark, rows, SF).select("doc_id").distinct().count() == (8 if n else 0)
