"""Periodic runs against a plain search of all periods."""

import hashlib
import random
import zlib

import pytest

from corpusq.llm.periodic_runs import WORD, Limits, find_runs, periodic_runs, tiled
from corpusq.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(words, limits=Limits()):
    out, n = [], len(words)
    for p in range(1, n // limits.times + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            stretch, length = words[i : j + p], j - i + p
            if j > i and length >= max(limits.words, limits.times * p):
                if not any(all(stretch[x] == stretch[x + q] for x in range(length - q)) for q in range(1, p)):
                    out.append((i, length, p))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def dropped(words, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@pytest.mark.parametrize("seed", range(4))
def test_all_runs_are_found(seed):
    rng = random.Random(seed)
    for _ in range(150):
        texts = []
        for _ in range(rng.randint(1, 5)):
            words = [rng.choice("abc"[: rng.randint(1, 3)]) for _ in range(rng.randint(0, 60))]
            if rng.random() < 0.6:
                words = tiled(words, rng.randint(0, 1000))
            if rng.random() < 0.4:
                words = words + tiled([rng.choice("abcdefgh") for _ in range(rng.randint(0, 40))], rng.randint(0, 1000))
            texts.append(words)
        for words, got in zip(texts, find_runs(texts), strict=True):
            assert [tuple(r) for r in got.tolist()] == brute(words)


def test_periods_beyond_words_of_a_level():
    for p in [1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17, 31, 33, 64, 100]:
        words = [f"x{i}" for i in range(p)] * 4
        assert find_runs([["a", *words, "b"]])[0].tolist() == ([[1, 4 * p, p]] if 4 * p >= 6 else [])
        assert find_runs([words[:-1]])[0].tolist() == []


def test_limits():
    words = ("a b " * 5).split()
    assert find_runs([words], Limits(11, 4))[0].tolist() == [] and find_runs([words], Limits(10, 5))[0].tolist() == [[0, 10, 2]]
    with pytest.raises(ValueError):
        Limits(times=3)


def test_registered_query(spark, documents):
    got = {r.doc_id: r for r in QUERIES["op13_basic_factors"](spark, SF).collect()}
    rows = documents.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    made = 0
    for doc in rows:
        words, h = WORD.findall(doc.text or ""), zlib.crc32(str(doc.doc_id).encode())
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs, r = brute(words), got[doc.doc_id]
        made += bool(runs)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else None
        assert r.n_runs == len(runs)
        assert (r.start, r.length, r.period, r.exponent_milli) == ((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(dropped(words, runs).encode()).hexdigest()
    assert made > 5


def test_odd_rows(spark, odd, none):
    got = periodic_runs(odd, ["doc_id", "n", "starts", "collapsed"] if "starts" in odd.columns else ["doc_id", "n"]).collect()
    assert len(got) == odd.count()
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by_id[1].n_words == 0 and by_id[1].collapsed == "" and by_id[2].starts == [] and by_id[3].collapsed == ""
    assert by_id[6].n_words == by_id[7].n_words and by_id[9].n_words == 1
    assert periodic_runs(none, ["doc_id"]).count() == 0
    # Only the six blanks part words; other spaces and controls belong to them.
    text = "x\u00a0y\x1cz\x00 " * 8 + "\x0b\x0c\x85"
    one = periodic_runs(spark.createDataFrame([(1, text, "clash")], "doc_id long, text string, periods string"), ["doc_id", "periods"]).first()
    assert (one.n_words, one.starts, one.lengths, one.periods) == (9, [0], [8], [1]) and one.collapsed == "x\u00a0y\x1cz\x00 \x85"
