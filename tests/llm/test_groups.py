"""Near duplicates and benchmark decontamination against brute force."""

import math
from collections import Counter, defaultdict

import numpy as np
import xxhash

from corpusq.llm import decontaminate as D
from corpusq.llm import near_duplicates as N
from corpusq.llm.queries import QUERIES
from corpusq.llm.texts import PLAIN_WORD, word_hashes

SF = "/root/testdata/sf0.001"


def brute_classes(rows, weights):
    """Exact weighted Jaccard of all pairs of texts that share a shingle, and union-find."""
    bags = N.Bags(weights)
    by_text = defaultdict(list)
    for i, t in rows:
        if i is not None and t is not None:
            by_text[t].append(i)
    bag = {t: bags.bag(t) for t in by_text}
    parent = {t: t for t in by_text}

    def root(t):
        while parent[t] != t:
            t = parent[t]
        return t

    where = defaultdict(set)
    for t, (grams, _) in bag.items():
        for g in grams.tolist():
            where[g].add(t)
    pairs = {(a, b) for ts in where.values() for a in ts for b in ts if a < b}
    for a, b in pairs:
        if N.weighted_jaccard(bag[a], bag[b]) >= weights.settings.similar:
            parent[root(a)] = root(b)
    groups = defaultdict(list)
    for t, ids in by_text.items():
        groups[root(t)] += ids
    return {i: min(ids) for ids in groups.values() for i in ids}


def test_near_duplicates_equal_brute_force(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    weights = N.document_weights(documents, N.Settings())
    wanted = brute_classes(rows, weights)
    found = QUERIES["op6_weighted_minhash"](spark, SF).collect()
    assert {r.doc_id: r.class_id for r in found} == wanted and len(found) == len(rows)
    copies = Counter(t for _, t in rows)
    assert {r.doc_id: r.copies for r in found} == {i: copies[t] for i, t in rows}


def edited(rng, words, edits):
    words = list(words)
    for k in rng.choice(len(words), edits, replace=False):
        words[k] = f"new{rng.integers(10**9)}"
    return " ".join(words)


def test_groups_of_edited_copies(spark, monkeypatch):
    """A large group of copies edited independently, whose members mostly miss each other, and chains of links."""
    monkeypatch.setattr(N, "BLOCK_TEXTS", 7)
    rng = np.random.default_rng(8)
    rows, base = [], [f"w{k}" for k in range(150)]
    rows += [(k, edited(rng, base, int(rng.integers(1, 6)))) for k in range(60)]
    other = [f"v{k}" for k in range(120)]
    chain = " ".join(other)
    for k in range(100, 112):
        rows.append((k, chain))
        chain = edited(rng, chain.split(), 2)
    rows += [(200 + k, edited(rng, [f"u{j}-{k}" for j in range(80)], 1)) for k in range(20)] + [(300 + k, " ".join(base)) for k in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    wanted = brute_classes(rows, N.document_weights(docs, N.Settings()))
    found = {r.doc_id: r.class_id for r in N.near_duplicates(docs).collect()}
    assert found == wanted
    kept = {r.doc_id for r in N.first_of_class(docs).collect()}
    assert kept == set(wanted.values())


def test_samples_agree_as_often_as_weights_overlap():
    rng = np.random.default_rng(4)
    s = N.Settings(samples=64)
    for share in (0.5, 0.8, 0.95):
        agree, want = [], []
        for _ in range(40):
            grams = rng.integers(0, 2**63, 400).astype(np.uint64)
            weights = rng.choice([1.0, 1.3, 2.1, 3.9], 400)
            left, right = rng.random(400) < (1 + share) / 2, rng.random(400) < (1 + share) / 2
            a, b = (grams[left], weights[left]), (grams[right], weights[right] * rng.choice([1.0, 1.0, 1.0, 2.0], 400)[right])
            a, b = ((g[np.argsort(g)], w[np.argsort(g)]) for g, w in (a, b))
            want.append(N.weighted_jaccard(a, b))
            agree.append((N.sample(*a, s) == N.sample(*b, s)).mean())
        assert abs(np.mean(agree) - np.mean(want)) < 0.03


def test_many_similarities_at_once():
    rng = np.random.default_rng(6)
    idf = rng.random(60) + 1

    def bag():
        grams = np.unique(rng.integers(0, 60, 25)).astype(np.uint64)
        return grams, rng.integers(1, 4, len(grams)) * idf[grams.astype(int)]

    left, right = {k: bag() for k in range(0, 60, 2)}, {k: bag() for k in range(40)}
    i, j = rng.choice(list(left), 800), rng.choice(list(right), 800)
    alone = [N.weighted_jaccard(left[a], right[b]) for a, b in zip(i, j)]
    assert np.allclose(N.all_jaccard(left, right, i, j), alone)


def test_document_frequencies_count_every_row(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (3, "a b c d e g"), (4, "x")], "doc_id long, text string").repartition(3)
    s = N.Settings()
    w = N.document_weights(docs, s)
    grams, _ = N.Bags(w).shingles("a b c d e")
    at = int(grams[0] >> np.uint64(64 - s.df_bits))
    assert np.isclose(w.idf[at], 1 + s.idf * np.log(5 / 4) / (s.df_bits * np.log(2)))


def test_frequencies_are_those_of_each_shingle(spark, documents, monkeypatch):
    monkeypatch.setattr(N, "CHUNK_BYTES", 20_000)
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    s, count = N.Settings(), Counter()
    w = N.document_weights(documents, s)
    bags = N.Bags(w)
    for _, t in rows:
        count.update(set(bags.all_shingles(t).tolist()))
    for _, t in rows[:200]:
        grams, weights = bags.bag(t)
        times = bags.shingles(t)[1]
        df = np.array([count[g] for g in grams.tolist()])
        assert np.allclose(weights, times * (1 + s.idf * np.log((len(rows) + 1) / (df + 1)) / (s.df_bits * np.log(2))))
    grams = np.unique(np.random.default_rng(1).integers(0, 2**63, 500).astype(np.uint64) * np.uint64(2))
    assert (N._stretched(N._squeezed(grams)) == grams).all() and (N._stretched(N._squeezed(grams[:1])) == grams[:1]).all()


def test_samples_rule_out_next_to_no_pair():
    s = N.Settings()
    missed = sum(math.comb(s.samples, k) * s.similar**k * (1 - s.similar) ** (s.samples - k) for k in range(s.least_matches))
    assert missed < 1e-8


def test_connected_chains(spark):
    pairs = [(k, k + 1) for k in range(0, 40)] + [(100, 101), (101, 102), (103, 102)]
    rows = [(bytes([0, a]), bytes([0, b])) for a, b in pairs]
    labels = {r.key[1]: r.label[1] for r in N.connected(spark.createDataFrame(rows, "a binary, b binary")).collect()}
    assert labels == {k: 0 if k <= 40 else 100 for k in [*range(41), 100, 101, 102, 103]}


def test_odd_near_duplicates(odd, none):
    rows = [(r.doc_id, r.class_id) for r in N.near_duplicates(odd).collect()]
    assert len(rows) == odd.count()
    assert dict(rows) == {None: None, 1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6, 7: 6, 8: 2, 9: 9}
    kept = N.first_of_class(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["None", "None", "1", "2", "3", "4", "5", "6", "9"])
    assert N.near_duplicates(none).count() == 0 and N.first_of_class(none).count() == 0


def brute_contamination(docs, items, similar=D.SIMILARITY):
    """Every window of every item's length in every text."""
    grams = lambda w: [tuple(w[k : k + min(D.SIZE, len(w))]) for k in range(len(w) - min(D.SIZE, len(w)) + 1)]
    plain = lambda t: [w.lower() for w in PLAIN_WORD.findall(t or "")]
    words = {i: plain(t) for i, t in items if plain(t)}
    found = {}
    for d, text in docs:
        doc = plain(text)
        for i, w in words.items():
            wide = min(len(w), len(doc))
            if wide < min(D.SIZE, len(w)):
                continue
            n, b = min(D.SIZE, len(w)), Counter(grams(w))
            for s in range(len(doc) - wide + 1):
                part = doc[s : s + wide]
                a = Counter(tuple(part[k : k + n]) for k in range(len(part) - n + 1))
                if not a.keys() & b.keys():
                    continue
                weight = lambda g: sum(map(len, g))
                low = sum(min(c, b[g]) * weight(g) for g, c in a.items())
                high = sum(max(a[g], b[g]) * weight(g) for g in a.keys() | b.keys())
                if high and low / high >= similar - 1e-12:
                    found[d, i] = max(found.get((d, i), 0), low / high)
    return found


def test_contamination_equals_brute_force(spark):
    rng = np.random.default_rng(12)
    vocabulary = [f"t{k}" for k in range(60)]
    draw = lambda n: rng.choice(vocabulary, n).tolist()
    items = [(k, " ".join(draw(int(rng.integers(15, 50))))) for k in range(12)] + [(20, "only three words"), (21, ""), (22, None)]
    items.append((23, items[0][1]))  # two items of one text
    docs = []
    for k in range(60):
        words, item = draw(150), items[k % 12][1].split()
        at = int(rng.integers(0, 150))
        if k % 3 == 0:
            words[at:at] = item
        elif k % 3 == 1:
            words[at:at] = [w for j, w in enumerate(item) if j != len(item) - 2] + ["end"]
        docs.append((k, " ".join(words)))
    docs += [(100, items[3][1]), (101, ""), (102, None), (103, "well, ONLY Three words!"), (104, " ".join(items[4][1].split()[:-1]))]
    found = D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), ["doc_id"]).collect()
    wanted = brute_contamination(docs, items)
    assert {(r.doc_id, r.item_id) for r in found} == set(wanted)
    assert all(abs(r.similarity - wanted[r.doc_id, r.item_id]) < 1e-9 for r in found)
    texts = dict(docs)
    row = next(r for r in found if r.doc_id == 103)
    assert texts[103][row.start : row.end] == "ONLY Three words"


def test_blocks_find_all_within_the_radius():
    rng = np.random.default_rng(1)
    items = D.Items([(k, " ".join(f"i{k}w{j}" for j in range(20))) for k in range(30)], 0.8)
    for _ in range(300):
        print_ = items.prints[rng.integers(30)].copy()
        for bit in rng.choice(128, rng.integers(0, 45), replace=False):
            print_[bit // 16] ^= np.uint16(1 << (bit % 16))
        distance = [int(np.bitwise_count(p ^ print_).sum()) for p in items.prints]
        assert items.within(print_) == [(k, d) for k, d in enumerate(distance) if d <= D.RADIUS]


def test_contamination_query_holds_all_verbatim_passages(spark, documents):
    found = {(r.doc_id, r.item_id) for r in QUERIES["op2_simhash_windows"](spark, SF).collect()}
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    verbatim = {(d.doc_id, i.item_id) for d in documents.collect() for i in items if i.text in d.text}
    assert verbatim <= found and verbatim
    assert found == set(brute_contamination([(r.doc_id, r.text) for r in documents.collect()], [(i.item_id, i.text) for i in items]))


def test_items_are_passed_by_number_and_length(monkeypatch, spark):
    items = spark.createDataFrame([(k, f"item {k} " * 10) for k in range(40)] + [(50, None)], "item_id long, text string")
    assert [len(p) for p in D.item_passes(items)] == [40]
    for name, bound in (("ITEMS_PER_PASS", 7), ("CHARS_PER_PASS", 900)):
        with monkeypatch.context() as m:
            m.setattr(D, name, bound)
            passes = D.item_passes(items)
        assert len(passes) > 3 and sorted(k for p in passes for k, _ in p) == list(range(40))


def test_thousands_of_items_in_one_index(documents):
    """Items out of the documents themselves, among others: each is found where it stands, as by comparison with all fingerprints."""
    rng = np.random.default_rng(8)
    texts = [r.text for r in documents.orderBy("doc_id").limit(40).collect()]
    long = [t.split() for t in texts if len(t.split()) > 60]
    items = [(k, " ".join(f"x{w}" for w in rng.integers(0, 5000, 30))) for k in range(3000)]
    own = {3000 + k: " ".join(w[5:45]) for k, w in enumerate(long)}
    index, hashes = D.Items(items + list(own.items()), 0.8), D.PlainHashes()
    for k, words in enumerate(long):
        text = " ".join(words)
        assert index.search(hashes.of_text(text), text)[3000 + k][0] == 1.0
    prints = index.prints[rng.integers(0, len(index.ids), 400)] ^ (np.uint16(1) << rng.integers(0, 16, (400, 8)).astype(np.uint16))
    for print_, near in zip(prints, index.all_within(prints)):
        distance = np.bitwise_count(index.prints ^ print_).sum(1)
        assert near == [(int(i), int(distance[i])) for i in np.flatnonzero(distance <= D.RADIUS)]


def test_clean_documents(monkeypatch, spark, odd, none):
    items = spark.createDataFrame([(k, f"alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho item{k}") for k in range(6)] + [(9, None), (None, "one")], "item_id long, text string")
    monkeypatch.setattr(D, "ITEMS_PER_PASS", 2)
    kept = D.clean_documents(odd, items)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in odd.exceptAll(kept).collect()) == ["6", "7"]
    assert D.clean_documents(none, items).count() == 0
    assert D.clean_documents(odd, items.limit(0)).count() == odd.count()


def test_draws_of_the_usual_weight_are_kept(monkeypatch):
    """Only shingles of another weight are worked out again; the samples do not depend on what is kept."""
    rng, s = np.random.default_rng(12), N.Settings()
    weights = np.where(np.arange(5000) % 10 == 0, rng.choice([1.1, 2.4, 3.6], 5000), 1.2)
    grams = np.unique(rng.integers(0, 2**63, 5000, dtype=np.uint64))[: len(weights)]
    weights = weights[: len(grams)]
    plain = N.sample(grams, weights, s, 7.5)
    N.sample(grams[:1], weights[:1], s, 1.2)
    worked, scores = [], N._scores
    monkeypatch.setattr(N, "_scores", lambda draws, log_w: worked.append(len(draws)) or scores(draws, log_w))
    assert (N.sample(grams, weights, s, 1.2) == plain).all()
    assert sum(worked) == (weights != 1.2).sum() * s.samples // 16


def test_word_hashes_are_those_of_xxhash_and_not_remembered():
    words = ["a", "bé", "\ud800", "a", ""]
    wanted = [xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words]
    assert word_hashes(words).tolist() == wanted and word_hashes([]).tolist() == []
