"""op13 against brute force."""

import re

import numpy as np
import pyarrow as pa
import pytest

from lacunar.llm import jaccard

SCHEMA = "doc_id long, text string, name int, size string, file int, shard long, token string"
SPACE = re.compile("[\x20\x09-\x0d]+")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "s", 2, 3, None) for i, t in rows], SCHEMA)


def shingled(text, n):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in SPACE.split(low) if w]
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else ({tuple(words)} if words else set())


def brute(rows, n, percent):
    sets = [shingled(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[find(i)] = min(d, ids.get(find(i), d))
    return sorted((d if d is not None else -1, len(s), ids.get(find(i), -1)) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True)))


def found(df):
    return sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_shingles"], r["component_id"] if r["component_id"] is not None else -1) for r in df.collect())


def corpus(seed, n=150):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = []
    while len(rows) < n:
        words = list(rng.choice(vocabulary, int(rng.integers(3, 160))))
        rows.append((len(rows), " ".join(words)))
        for _ in range(int(rng.integers(0, 4))):
            copy = list(words)
            for _ in range(int(rng.integers(0, 1 + len(words) // 30 + 1))):
                copy[int(rng.integers(0, len(copy)))] = str(rng.choice(vocabulary))
            rows.append((len(rows), ("  " if rng.random() < 0.3 else " ").join(copy).upper() if rng.random() < 0.2 else " ".join(copy)))
    return rows


ODD = [(900, None), (901, ""), (902, " \t\n"), (903, "one"), (904, "ONE"), (905, "one two"), (906, "é ü ß"), (907, "É ü ß"), (908, "a b c d"), (909, "a b c d"), (None, "one"), (None, "only here now"), (3, "one two"), (3, "quite another text than the third")]


@pytest.mark.parametrize(("shingle", "percent"), [(3, 90), (5, 80), (1, 60)])
def test_components(spark, shingle, percent):
    rows = [*corpus(shingle), *ODD]
    assert found(jaccard.jaccard_components(frame(spark, rows).repartition(5), shingle, percent)) == brute(rows, shingle, percent)


def test_cells_of_crowded_keys(spark, monkeypatch):
    """A group of near copies, far more than fit into a cell or a bucket; texts without rare shingles."""
    for name, value in (("PART", 8), ("ROWS", 300), ("BUCKET", 20), ("PAIRS", 50), ("KEYS", 400)):
        monkeypatch.setattr(jaccard, name, value)
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(80)]
    rows = [(i, " ".join([*words[:i % 80], f"x{i % 50}", *words[i % 80 :]])) for i in range(120)]
    rows += [(1000 + i, " ".join(rng.choice(["a", "b"], 40))) for i in range(80)]
    rows += [(2000 + i, rows[i][1]) for i in range(40)]
    assert found(jaccard.jaccard_components(frame(spark, rows).repartition(4), 3, 90)) == brute(rows, 3, 90)


def test_pairs_are_compared_once(monkeypatch):
    """A pair of a cell is compared once, or not at all when it is joined already; of two sides only across."""
    rule, compared = jaccard.Rule(90), []
    plain = rule.linked
    monkeypatch.setattr(rule, "linked", lambda a, b, shared: compared.extend([1] * len(b)) or plain(a, b, shared))
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 2**40, 100).astype(np.uint64)) for _ in range(12)]
    size = np.array([len(s) for s in sets])
    root = jaccard._joined(rule, np.arange(12), None, np.concatenate(sets), size, np.arange(12))
    assert len(compared) == 12 * 11 // 2 and (root == np.arange(12)).all()
    compared.clear()
    jaccard._joined(rule, np.arange(12), np.array([0] * 4 + [1] * 8), np.concatenate(sets), size, np.arange(12))
    assert len(compared) == 4 * 8
    compared.clear()
    root = jaccard._joined(rule, np.arange(12), None, np.concatenate([sets[0]] * 12), np.full(12, size[0]), np.arange(12))
    assert len(compared) == 11 and (root == 0).all()


def test_filters_lose_no_link():
    """A linked pair passes all filters at the first key that both have."""
    rule = jaccard.Rule(90)
    rng = np.random.default_rng(3)
    for _ in range(50):
        a = np.unique(rng.integers(0, 400, 120))
        b = np.unique(np.append(rng.choice(a, len(a) - 3, replace=False), rng.integers(0, 400, 3)))
        shared = len(np.intersect1d(a, b))
        x, y = a[: rule.prefix(len(a))], b[: rule.prefix(len(b))]
        common = np.intersect1d(x, y)
        if rule.linked(len(a), len(b), shared):
            assert len(common) and common[0] == np.intersect1d(a, b)[0]
            i, j = np.searchsorted(a, common[0]), np.searchsorted(b, common[0])
            assert rule.length(len(a), len(b)) and rule.position(len(a), len(b), i, j)
            count = lambda s: np.minimum(255, np.bincount(s % jaccard.RANGES, minlength=jaccard.RANGES)).astype(np.uint8)[None]
            assert rule.suffix(np.array([len(a)]), np.array([len(b)]), count(a), count(b)).all()


def test_very_long_text(spark):
    rng = np.random.default_rng(2)
    words = [f"v{i}" for i in rng.integers(0, 5000, 60_000)]
    near = list(words)
    near[100] = near[30_000] = "changed"
    rows = [(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(words[:30_000])), (4, " ".join(words[:20]))]
    assert found(jaccard.jaccard_components(frame(spark, rows), 3, 90)) == brute(rows, 3, 90)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "a b")]])
def test_smallest(spark, rows):
    assert found(jaccard.jaccard_components(frame(spark, rows), 3, 90)) == brute(rows, 3, 90)


def test_shingles_are_sequences_of_words():
    texts = pa.array(["a b c", "c b a", "ab c", "a bc", "a b", "A  B\tC", None, "a b c a b c"])
    h, n = jaccard.shingles(texts, 3)
    assert n.tolist() == [1, 1, 1, 1, 1, 1, 0, 4] and len(set(h[:5].tolist())) == 5 and h[5] == h[0] and h[6] == h[9] == h[0]
