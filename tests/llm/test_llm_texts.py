"""The operators on documents against brute force, over odd texts."""

import collections
import hashlib
import json
import math
import os
import random
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from lacunar.llm import bitplane, blocks, licenses, mixing, packing, similar, simhash, substrings, suffix_tree, tokens, toxicity
from lacunar.llm.queries import tokenizer_path
from lacunar.llm.tokens import Encoder

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, score string, bucket int, block_id string, fp int, held_out string, answers int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None, "9", "s", 1, "b", 2, "h", 3) for i, t, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    words = ["the", "of", "La", "étude", "idiot", "Über", "x1", "—", "foo.", "bar,", "it's", "日本", "a b", "THE"] + [f"w{i}" for i in range(60)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared = text(45)
    out = [(i, text(rng.choice([3, 30, 90])), rng.choice(["a", "b", "B", None])) for i in range(60)]
    out += [(100 + i, f"{text(25)} {shared}\n{text(10)}", "a") for i in range(12)]
    out += [(200, None, None), (201, "", "a"), (202, " \t\n ", "b"), (203, "one", "c"), (204, "x " * 3000, "c"), (205, text(20000), "a"), (206, "a  b \x0b c d ", "c")]
    out += [(300 + i, out[3][1], "a") for i in range(4)] + [(400, out[1][1] + " z", "b"), (None, text(30), "a")]
    rng.shuffle(out)
    return out


def split(t, lower=False):
    b = (t or "").encode()
    return (b.lower() if lower else b).split()


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


@pytest.mark.parametrize("planes", ["byte", "bit"])
def test_planes(spark, rows, planes):
    got = by_id(bitplane.encode_and_read_back(spark, frame(spark, rows), tokenizer_path("word_bpe_49k.json"), 2, planes, 20))
    tk = Encoder.of(tokenizer_path("word_bpe_49k.json")).tokenizer
    at = 0
    for i, t, _ in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        ids = np.array([*tk.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_planes_of_one_id(spark, rows, tmp_path):
    """An id of a third of all rows, and no id at all, are dealt to many files; order and rows stay whole."""
    more = [*rows, *((7777, f"same {i}", "a") for i in range(150)), *((None, f"none {i}", "a") for i in range(150))]
    docs = frame(spark, more)
    manifest = bitplane.write_planes(docs, str(tmp_path / "files"), tokenizer_path("word_bpe_49k.json"), 2, shard_docs=20)
    files = manifest.collect()
    assert len(files) > 15 and max(r["n_docs"] for r in files) <= 40 and sum(r["n_docs"] for r in files) == len(more)
    got = bitplane.read_digest(manifest).collect()
    got.sort(key=lambda r: r["start"])
    tk = Encoder.of(tokenizer_path("word_bpe_49k.json")).tokenizer
    crc = lambda t: zlib.crc32(np.array([*tk.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes())
    assert sorted((str(r["doc_id"]), r["ids_crc32"]) for r in got) == sorted((str(i), crc(t)) for i, t, _ in more)
    order = [(r["doc_id"] is None, r["doc_id"] or 0) for r in got]
    assert order == sorted(order) and all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(got, got[1:]))


def test_unknown_tokenizer(spark, tmp_path):
    """Tokens of a tokenizer of another shape may span spaces: its texts are not cut."""
    vocab = {c: i for i, c in enumerate("ab ")} | {"a b": 3, "a ": 4, "<": 5}
    spec = {"version": "1.0", "truncation": None, "padding": None, "added_tokens": [], "normalizer": None, "pre_tokenizer": {"type": "Split", "pattern": {"String": "<"}, "behavior": "Isolated", "invert": False}, "post_processor": None, "decoder": None, "model": {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None, "fuse_unk": False, "byte_fallback": False, "vocab": vocab, "merges": [["a", " "], ["a ", "b"]]}}
    (tmp_path / "t.json").write_text(json.dumps(spec))
    e = Encoder(str(tmp_path / "t.json"))
    texts = ["a b", "a ba b", "", "b a b", "a b"]
    ids, off = e.encode(pa.array([*texts, None]), 9)
    assert not e.plain
    for t, a, b in zip([*texts, ""], off, off[1:]):
        assert ids[a:b].tolist() == [*e.tokenizer.encode(t, add_special_tokens=False).ids, 9]
    assert 3 in ids


@pytest.mark.parametrize("planes", ["byte", "bit"])
def test_blocks_round_trip(planes):
    rng = np.random.default_rng(0)
    for top in (1, 255, 256, 70000, 2**40, 2**64 - 1):
        v = rng.integers(0, top, 1001, dtype=np.uint64, endpoint=True)
        width, parts = bitplane.shuffle_block(v, planes)
        assert (bitplane.unshuffle_block(parts, len(v), width, planes) == v).all()


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_plain_words_take_the_short_way(name, monkeypatch):
    """A space, letters and perhaps a mark need neither the pattern nor the table; ids are the library's, ends included."""
    words = ["über", "Straße", "naïve", "The", "THE", "ªb", "x"]
    plain = [w + m for w in words for m in ("", ".", ",", "!", "?", ":", ";")]
    odd = ["a1", "don't", "<unk>", "!!", "Ωmega", "日本", "a..", "", "\n", "\nTo", "a\u00a0b", "ǅ", "b\u0301"]
    encoder = tokens.Encoder(tokenizer_path(name))
    seen, ids = [], encoder._ids
    monkeypatch.setattr(encoder, "_ids", lambda piece: seen.append(piece) or ids(piece))
    texts = ["", *(" " + w for w in plain + odd), " " + " ".join(plain + odd), None]
    got, at = encoder.encode(pa.array(texts), end=1)
    for t, a, b in zip(texts, at, at[1:], strict=False):
        assert got[a:b].tolist() == [*encoder.tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
    assert not {(" " + w).encode() for w in plain} & set(seen)


def test_distinct_windows_are_sorted(monkeypatch):
    """np.unique hashes unless it is asked for places; a block's windows and counters must not pass it that way."""
    unique = np.unique

    def placed(values, *args, **kwargs):
        assert any(kwargs.get(k) for k in ("return_index", "return_inverse", "return_counts"))
        return unique(values, *args, **kwargs)

    assert [substrings._distinct(np.array(v, np.uint64)).tolist() for v in ([], [7], [2**64 - 1, 0, 2**64 - 1, 5, 5])] == [[], [7], [0, 5, 2**64 - 1]]
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(words), " ".join(words[50:150]), "short", None, " ".join(words[:20] * 3)]
    block = blocks.freeze(pa.table({"doc_id": pa.array(range(5), pa.int64()), "text": pa.array(texts)}))
    monkeypatch.setattr(np, "unique", placed)
    sends = [r for batch in substrings._sketch(16, 14)(0, block, {}) for r in batch.to_pylist()]
    assert len(sends) == 8  # two rows of four shards
    answers = {bucket: data for r in sends for _, bucket, data in substrings._merge(14)(r["bucket"], [0, 1], [r["data"], r["data"]])}
    sent = [r for batch in substrings._exact(16, 14, 1)(0, block, answers) for r in batch.to_pylist()]
    assert {r["bucket"]: len(blocks.grow(r["data"])) for r in sent} == {0: 6, substrings.OWN: 1}
    w = substrings.Windows(pa.array(texts))
    assert len(blocks.grow(sent[0]["data"])[0]) == len(set(w.key.tolist())) < len(w.key)  # every window of two blocks, once


def test_pieces_are_encoded_once(monkeypatch):
    """300,000 distinct words stay known to a worker: a second reading encodes none of them. Ids stay right when the cache starts again."""
    encoder = tokens.Encoder(tokenizer_path("byte_bpe_50k.json"))
    letters = "abcdefghij"
    words = [" " + "".join(letters[int(d)] for d in f"{i:06d}") for i in range(300_000)]
    texts = pa.array(["".join(words[i : i + 10_000]) for i in range(0, len(words), 10_000)])
    seen, every = [], encoder._all
    monkeypatch.setattr(encoder, "_all", lambda distinct: seen.append(len(distinct)) or every(distinct))
    ids, at = encoder.encode(texts, end=1)
    assert sum(seen) == len(words)
    again, at2 = encoder.encode(texts, end=1)
    assert sum(seen) == len(words) and (again == ids).all() and (at2 == at).all()
    assert ids[at[3] : at[4]].tolist() == [*encoder.tokenizer.encode(texts[3].as_py(), add_special_tokens=False).ids, 1]
    monkeypatch.setattr(tokens, "MAX_PIECES", 1000)
    for end in (1, 2, None):
        some, off = encoder.encode(texts[:2], end)
        assert some[: off[1] - (end is not None)].tolist() == ids[: at[1] - 1].tolist() and (end is None or some[off[1] - 1] == end)


def test_packing(spark, rows):
    got = packing.pack(frame(spark, rows), tokenizer_path("byte_bpe_50k.json"), end=1, tokens=128, with_ids=True).collect()
    tk = Encoder.of(tokenizer_path("byte_bpe_50k.json")).tokenizer
    docs, seqs = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        docs[r["doc_id"]].append(r)
        seqs[r["sequence_id"]].append(r)
    for i, t, _ in rows:
        ids = [*tk.encode(t or "", add_special_tokens=False).ids, 1]
        mine = sorted(docs[i], key=lambda r: r["start"])
        assert [x for r in mine for x in r["ids"]] == ids and all(r["doc_tokens"] == len(ids) for r in mine)
        assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in mine)
    short = 0
    for s in seqs.values():
        at = 0
        for r in sorted(s, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 128
        short += at < 128
    assert short <= 4  # a task's last sequence


def test_packing_limits():
    p = packing.Packer(100, 3, 40)
    rng = np.random.default_rng(1)
    n = rng.integers(1, 150, 200)
    p.add(np.arange(200), n, rng.integers(0, 150, 200))
    seqs = collections.defaultdict(list)
    for piece in p.fill(0):
        seqs[piece[3]].append(piece)
    assert all(sum(x[2] for x in s) <= 100 and len(s) <= 3 and sum(x[5] for x in s) <= 40 for s in seqs.values())
    total = collections.Counter()
    for s in seqs.values():
        for x in s:
            total[x[0]] += x[2]
    assert total == {i: k for i, k in enumerate(n.tolist())}


def plain_pack(docs, tokens, segments, loss):
    """The heuristic in plain Python: docs are (tokens, tokens without loss)."""
    waiting = [[i, 0, n, min(free, n)] for i, (n, free) in enumerate(docs)]
    out, seq = [], 0
    while any(w[2] for w in waiting):
        room = [tokens, segments, loss]
        long = [w for w in waiting if w[2] > tokens or w[2] - w[3] > loss]
        while room[0] >= 1 and room[1] >= 1:
            open_ = [w for w in waiting if w[2]]
            need = lambda w: max(0, w[2] - w[3])
            fits = [w for w in open_ if w[2] <= room[0] and need(w) <= room[2]]
            if long:
                best = max(long, key=lambda w: (w[2], -w[0]))
                take, long = min(best[2], tokens, best[3] + loss), []
            elif fits and (room[1] > 1 or any(w[2] == room[0] for w in fits)):
                value = lambda w: room[0] / tokens * w[2] / tokens + room[1] / segments / segments + room[2] / loss * need(w) / loss
                best = max(fits, key=lambda w: (round(value(w), 12), -w[0], -w[1]))
                take = best[2]
            else:
                piece = lambda w: min(w[2], room[0], w[3] + room[2])
                best = max(open_, key=lambda w: (piece(w), w[2], -w[0]), default=None)
                take = piece(best) if best else 0
                if take < 1:
                    break
            lossy = max(0, take - best[3])
            out.append((best[0], best[1], take, seq, tokens - room[0], lossy))
            best[1], best[2], best[3] = best[1] + take, best[2] - take, max(0, best[3] - take)
            room = [room[0] - take, room[1] - 1, room[2] - lossy]
        seq += 1
    return out


@pytest.mark.parametrize(("segments", "loss"), [(3, 90), (6, 97), (50, 100)])
def test_packing_takes_the_largest_dot_product(segments, loss):
    rng = np.random.default_rng(segments)
    n = rng.choice([2, 5, 9, 30, 70, 180, 600], 160) + rng.integers(0, 7, 160)
    docs = [(int(x), int(x) // 8) for x in n]
    p = packing.Packer(100, segments, loss)
    p.add(np.arange(160), n, n // 8)
    assert list(p.fill(0)) == plain_pack(docs, 100, segments, loss)


def test_packing_limits_bind(spark, rows):
    """Under the query's limits some sequences are closed by their segments, some by their loss, and few are short."""
    more = [*rows, *((2000 + i, "a b", "a") for i in range(400))]
    got = packing.pack(frame(spark, more).coalesce(1), tokenizer_path("byte_bpe_50k.json"), segments=packing.SEGMENTS, loss=packing.LOSS, prompt_share=packing.PROMPT_SHARE)
    seqs = collections.defaultdict(list)
    for r in got.collect():
        seqs[r["sequence_id"]].append(r)
        assert r["loss"] == max(0, r["start"] + r["length"] - max(r["start"], int(r["doc_tokens"] * packing.PROMPT_SHARE)))
    loss = [sum(r["loss"] for r in s) for s in seqs.values()]
    assert max(loss) == packing.LOSS and max(map(len, seqs.values())) == packing.SEGMENTS
    assert all(sum(r["length"] for r in s) <= packing.LENGTH for s in seqs.values())


def print_of(t):
    w = split(t, True)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 4]), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def roots(prints):
    names = sorted(set(prints))
    root = {n: n for n in names}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i, a in enumerate(names):
        for b in names[:i]:
            if (a ^ b).bit_count() <= 4:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in names}


def test_simhash(spark, rows):
    prints = [print_of(t) for _, t, _ in rows]
    root = roots(prints)
    least = {}
    for (i, _, _), p in zip(rows, prints):
        if i is not None:
            least[root[p]] = min(i, least.get(root[p], i))
    got = sorted((str(r["doc_id"]), r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(frame(spark, rows), shingle=4, distance=4).collect())
    assert got == sorted((str(i), f"{p:016x}", least.get(root[p])) for (i, _, _), p in zip(rows, prints))


@pytest.mark.parametrize(("code", "owners", "copies"), [("golay", 1 << 14, 1 << 16), ("all", 1 << 14, 1 << 16), ("golay", 2, 3)])
def test_simhash_links(spark, monkeypatch, code, owners, copies):
    monkeypatch.setattr(simhash, "OWNERS", owners)
    monkeypatch.setattr(simhash, "COPIES", copies)
    rng = random.Random(5)
    prints = [rng.getrandbits(64) for _ in range(60)]
    for p in prints[:30]:
        for _ in range(5):
            for b in rng.sample(range(64), rng.randint(1, 5)):
                p ^= 1 << b
            prints.append(p)
    prints = sorted(set(prints))
    want = roots(prints)
    signed = lambda p: p - (1 << 64) if p >> 63 else p
    e = simhash.links(spark.createDataFrame([(signed(p),) for p in prints], "fp long"), code).collect()
    assert len(e) <= 3 * len(prints) * 6 and all(want[r["u"] % 2**64] == want[r["v"] % 2**64] for r in e)
    label = {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(e, "u long, v long")).collect()} if e else {}
    a, b = collections.defaultdict(set), collections.defaultdict(set)
    for p in prints:
        a[label.get(signed(p), signed(p))].add(p)
        b[want[p]].add(p)
    assert sorted(map(sorted, a.values())) == sorted(map(sorted, b.values()))


@pytest.mark.parametrize("part", [2048, 3])
def test_similar_documents(spark, rows, monkeypatch, part):
    """Groups of similarity 0.8 or more against brute force; op5's rule leaves most of these near copies."""
    monkeypatch.setattr(similar, "PART", part)
    rng = random.Random(9)
    docs = [(i, t) for i, t, _ in rows]
    for k in range(120):
        w = [f"v{rng.randrange(5000)}" for _ in range(rng.randint(60, 300))]
        docs.append((1000 + 4 * k, " ".join(w)))
        for copy in range(1, 3):
            for _ in range(max(1, len(w) * copy // 60)):
                w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
            docs.append((1000 + 4 * k + copy, " ".join(w)))
    sets = []
    for _, t in docs:
        w = split(t, True)
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(docs)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] == sets[j] or 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    want = sorted((str(d), str(least.get(find(i)))) for i, (d, _) in enumerate(docs))
    got = simhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"])) for r in got) == want
    copies = {i for i, c in want if i != c and i != "None" and int(i) >= 1000}
    loose = {str(r["doc_id"]) for r in simhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), shingle=4, distance=4).collect() if r["doc_id"] != r["component_id"]}
    assert len(copies) > 100 and len(copies & loose) < len(copies) / 2


def kept(rows):
    seen, out = set(), {}
    for i, t, _ in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        w = split(t)
        gone = [False] * len(w)
        for k in range(len(w) - 19):
            key = tuple(w[k : k + 20])
            if key in seen:
                gone[k : k + 20] = [True] * 20
            seen.add(key)
        out[i] = (len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g))
    return out


@pytest.mark.parametrize(("limit", "width", "bits"), [(1 << 23, 8, 24), (2000, 8, 24), (2000, 1, 12)])
def test_substrings(spark, rows, monkeypatch, limit, width, bits):
    monkeypatch.setattr(substrings, "WIDTH_PER_WINDOW", width)
    monkeypatch.setattr(substrings, "SHARD_BITS", bits)
    monkeypatch.setattr(substrings, "pack_blocks", lambda *a: blocks.pack_blocks(*a, limit=limit))
    want = kept(rows)
    got = by_id(substrings.repeated_spans(frame(spark, rows)))
    assert {i: (r["n_words"], r["n_removed"], r["kept_sha256"]) for i, r in got.items()} == {i: (n, k, hashlib.sha256(b).hexdigest()) for i, (n, k, b) in want.items()}
    assert sum(k for _, k, _ in want.values()) > 3000
    docs = frame(spark, rows)
    texts = substrings.remove_repeats(docs)
    assert texts.columns == docs.columns
    for i, r in by_id(texts).items():
        if want[i][1]:
            assert r["text"].encode() == want[i][2]


def test_no_window_at_all(spark):
    docs = frame(spark, [(1, "a b", "s"), (2, None, None), (3, "a b", "s")])
    assert sorted((r["doc_id"], r["n_words"], r["n_removed"]) for r in substrings.repeated_spans(docs).collect()) == [(1, 2, 0), (2, 0, 0), (3, 2, 0)]


def test_licenses(spark, rows):
    more = [*rows, (900, "Licensed under CC BY-NC 4.0. All rights reserved. all  RIGHTS-reserved", "a"), (901, "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by someone", "a")]
    got = by_id(licenses.scan_licenses(frame(spark, more)))
    for i, t, _ in more:
        b = (t or "").encode().lower()
        w = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in b).split(b" ")
        w = [x for x in w if x]
        places = sorted((k, label) for p, label in licenses.BASE for k in range(len(w)) if w[k : k + len(p.split())] == p.encode().split())
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(w), len(places), places[0][0] if places else None, places[-1][0] if places else None)
        assert r["base_labels"] == ",".join(sorted({x for _, x in places})) and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
    assert got[900]["labels"] == "cc-by,cc-by-nc-4.0,reserved" and got[900]["n_base"] == 3
    assert got[901]["labels"] == "gpl" and got[901]["spans"][0]["covered"] > 0.8
    assert got[200]["score"] == 0.0 and got[200]["labels"] == ""


def test_every_license_span(spark):
    long = next(t for label, t in licenses.TEMPLATES if label == "mit" and len(t) > 100)
    short = "Released under the MIT license."
    n = len(long.split())
    other = "zebra " * 10
    texts = {1: short + other + short + other + long, 2: long + " " + long, 3: f"{short} {short} {short}", 4: other, 5: " ".join(long.split()[:20])}
    got = by_id(licenses.scan_licenses(frame(spark, [(i, t, "a") for i, t in texts.items()])))
    whole = {i: [(x["start"], x["stop"]) for x in r["spans"] if x["covered"] == 1.0] for i, r in got.items()}
    assert whole == {1: [(0, 5), (15, 20), (30, 30 + n)], 2: [(0, n), (n, 2 * n)], 3: [(0, 5), (5, 10), (10, 15)], 4: [], 5: []}
    assert [got[i]["labels"] for i in range(1, 6)] == ["mit", "mit", "mit", "", ""] and got[5]["score"] == pytest.approx(20 / n) and not got[5]["spans"]


def test_fragments_are_no_license(spark):
    """Fragments that are repeated or shuffled cover their words of the template once, and only in its order."""
    words = next(t for label, t in licenses.TEMPLATES if label == "mit" and len(t) > 100).split()
    n = len(words)
    parts = [words[i : i + 8] for i in range(0, n, 8)]
    texts = {1: "permission is hereby granted " * 30, 2: " ".join(" ".join(p) for p in reversed(parts)), 3: "redistribution and use in source and binary forms " * 9, 4: " x y ".join(" ".join(p) for p in parts)}
    got = by_id(licenses.scan_licenses(frame(spark, [(i, t, "a") for i, t in texts.items()])))
    assert [got[i]["labels"] for i in range(1, 5)] == ["", "", "", "mit"]
    assert got[1]["score"] == pytest.approx(4 / n) and got[2]["score"] < 0.2 and got[3]["score"] < 0.5 and got[4]["score"] > 0.9


def test_chains_by_brute_force():
    a = licenses.Automaton((("p", "a b c d a b e c d"), ("q", "c d a x b")), (("a b", "ab"),), 2)
    rng = random.Random(4)
    for _ in range(150):
        w = [rng.choice("abcdex") for _ in range(rng.randint(2, 22))]
        _, matches = a.stream([a.vocab[x] for x in w])
        found = {}
        for label, _, _, share in a.chains(matches):
            found[label] = max(share, found.get(label, 0.0))
        for words, label in a.templates:
            spots = [(s, e, k) for s, e, _ in matches for k in range(len(words) - (e - s) + 1) if list(words[k : k + e - s]) == w[s:e]]

            def best(upto):  # most template words of a chain that ends with this spot
                s, e, k = upto
                most = e - s
                for s0, e0, k0 in spots:
                    cut = max(0, e0 - s, k0 + e0 - s0 - k)
                    if s0 < s and k0 + e0 - s0 < k + e - s and cut < e - s and s + cut - e0 <= licenses.MAX_GAP:
                        most = max(most, best((s0, e0, k0)) + e - s - cut)
                return most

            assert found.get(label, 0.0) == pytest.approx(max((best(x) for x in spots), default=0) / len(words))


def test_automaton_statistics():
    a = licenses.Automaton((("p", "a b c d a b e"), ("q", "c d a x")), (("a b", "ab"),), 2)
    rng = random.Random(0)
    subs = {tuple(t.split()[i:j]) for t in ("a b c d a b e", "c d a x", "a b") for i in range(7) for j in range(i + 1, 8)}
    for _ in range(200):
        w = [rng.choice("abcdex") for _ in range(rng.randint(1, 25))]
        places, matches = a.stream([a.vocab[x] for x in w])
        assert sorted(places) == [(i, 0) for i in range(len(w)) if w[i : i + 2] == ["a", "b"]]
        longest = [max(n for n in range(i + 2) if n == 0 or tuple(w[i + 1 - n : i + 1]) in subs) for i in range(len(w))]
        want = [(i + 1 - n, i + 1) for i, n in enumerate(longest) if n >= 2 and (i + 1 == len(w) or longest[i + 1] != n + 1)]
        assert [m[:2] for m in matches] == want


@pytest.mark.parametrize("few", [50_000, 0])
def test_mixing(spark, rows, monkeypatch, few):
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", few)
    docs = frame(spark, rows)
    got = mixing.mix(docs).collect()
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs.repartition(7)).collect()))
    size, sizes = {i: len(split(t)) for i, t, _ in rows}, collections.Counter()
    for _, t, s in rows:
        sizes[s] += len(split(t))
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, target, full = sum(sizes.values()), {}, set()
    while True:
        level = (total - sum(3 * sizes[s] for s in full)) / max(1e-9, sum(weight[s] for s in order if s not in full))
        over = {s for s in order if s not in full and level * weight[s] > 3 * sizes[s]}
        if not over:
            break
        full |= over
    target = {s: 3 * sizes[s] if s in full else level * weight[s] for s in order}
    source = {i: s for i, _, s in rows}
    taken = collections.Counter()
    for r in got:
        s = source[r["doc_id"]]
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == sizes[s] and r["target"] == pytest.approx(target[s]) and 0 <= r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 1 for s in order)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    mixed = collections.Counter()
    for r in out.collect():
        mixed[r["doc_id"]] += len(split(r["text"]))
    assert mixed == collections.Counter({r["doc_id"]: r["taken"] for r in got if r["taken"]})


@pytest.mark.parametrize("scale", [1.0, 1e4, 1e-4])
def test_mixing_takes_by_key(spark, rows, monkeypatch, scale):
    """The documents taken are the first by Exp(1) / weight, whatever the size of the weights; null ids are spread, too."""
    monkeypatch.setattr(mixing, "INTERVALS", 16)
    rows = [*rows, *((None, f"null {i} " * 3, "a") for i in range(50))]
    weight = lambda i, t: scale * (1 + (len(t or "") * 7 + (i or 0)) % 5)
    docs = spark.createDataFrame([(k, i, t, s, weight(i, t)) for k, (i, t, s) in enumerate(rows)], "_mix_size long, doc_id long, text string, source string, q double")
    u = {r["_mix_size"]: r["h"] for r in docs.selectExpr("_mix_size", "shiftrightunsigned(xxhash64(coalesce(doc_id, 0), xxhash64(text), 20), 11) h").collect()}
    key = [-math.log((u[k] + 0.5) / 2**53) / weight(i, t) for k, (i, t, _) in enumerate(rows)]
    got = mixing.mixed_documents(docs, weight="q")
    assert got.columns == docs.columns
    taken = collections.Counter()
    for r in got.collect():
        taken[r["_mix_size"]] += len(split(r["text"]))
    size = [len(split(t)) for _, t, _ in rows]
    target = {r["source"]: r["target"] for r in mixing.targets(docs.select("source", mixing.F.expr("size(filter(split(coalesce(text, ''), '[\\\\x20\\\\x09-\\\\x0D]+'), x -> x <> ''))").cast("long").alias("size"))).collect()}
    for source, aim in target.items():
        mine = sorted((k for k, r in enumerate(rows) if r[2] == source), key=lambda k: (key[k], rows[k][0] is not None, rows[k][0] or 0))
        whole = sum(size[k] for k in mine)
        epochs = int(aim / whole + 1e-9) if whole else 0
        left = round(aim - epochs * whole)
        for k in mine:
            part = max(0, min(size[k], left))
            assert taken[k] == epochs * size[k] + part, (source, k)
            left -= size[k]


def test_mixing_prefers_heavy_documents(spark):
    docs = spark.createDataFrame([(i, "a b c", "s" if i % 2 else "t", 1.0 if i % 4 < 2 else 50.0) for i in range(4000)], "doc_id long, text string, source string, q double")
    p = mixing.plan(docs, weights=(1.0, 3.0), weight="q").where("_mix_epochs = 0 AND _mix_part > 0").select("doc_id").collect()
    heavy = sum(r["doc_id"] % 4 >= 2 for r in p)
    assert heavy > 0.9 * len(p) > 100


def test_suffix_tree(spark, rows, monkeypatch):
    monkeypatch.setattr(suffix_tree, "P_MIN", 2e-3)
    monkeypatch.setattr(suffix_tree, "pack_blocks", lambda *a: blocks.pack_blocks(*a, limit=3000))
    rows = [*rows, *((950 + i, ("p q r ", "s q u ")[i % 2] * 60, "a") for i in range(12))]
    end = b"\0end"
    texts = {i: [*split(t, True), end] for i, t, _ in rows}
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    count = collections.Counter(w for i, t in texts.items() if not held[i] for w in t)
    n, v = sum(count.values()), len(count)
    often = {w for w in count if count[w] >= 2e-3 * n}
    after = collections.defaultdict(collections.Counter)

    def suffixes(t, k):
        a, b = (t[k - 1] if k else end), (t[k - 2] if k > 1 else end if k else None)
        return [(a,) if a in often else None, (b, a) if a in often and b in often else None]

    for i, t in texts.items():
        for k in range(len(t)) if not held[i] else ():
            for s in filter(None, suffixes(t, k)):
                after[s][t[k]] += 1

    def shape(c):
        out = collections.Counter()
        for w, x in c.items():
            out[w if w in often else None] += x / sum(c.values())
        return out

    diverges = lambda s, q: sum(after[s].values()) >= 2e-3 * n and sum(p * math.log(p / q[w]) for w, p in shape(after[s]).items()) >= suffix_tree.MIN_DIVERGENCE
    one = {s for s in after if len(s) == 1 and diverges(s, shape(count))}
    two = {s for s in after if len(s) == 2 and s[1:] in one and diverges(s, shape(after[s[1:]]))}
    assert one and two
    for i, r in by_id(suffix_tree.suffix_tree_scores(frame(spark, rows), min_count=None, depth=2)).items():
        t, base, score = texts[i], 0.0, 0.0
        for k, w in enumerate(t):
            p = (count[w] + 1) / (n + v + 1)
            base += math.log10(p)
            for s, kept_ in zip(suffixes(t, k), (one, two)):
                if s in kept_:
                    c = after[s]
                    p = (c[w] + len(c) * p) / (sum(c.values()) + len(c))
            score += math.log10(p)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(t), sum(count[w] > 0 for w in t), n)
        assert r["base_score"] == pytest.approx(base) and r["score"] == pytest.approx(score)


def test_suffix_tree_keeps_no_files_of_done_levels(spark, rows, monkeypatch):
    plans = []
    monkeypatch.setattr(suffix_tree, "Plan", lambda *a, make=suffix_tree.Plan: plans.append(make(*a)) or plans[-1])
    before = suffix_tree.suffix_tree_scores(frame(spark, rows), min_count=6, depth=3)
    folder = Path(plans[0].folder.removeprefix("file://"))
    written = [f.stat().st_size for f in folder.parent.glob(f"{folder.name}*/*") if f.suffix != ".crc"]
    blocks_ = len(list(folder.glob("*")))
    assert before.count() and written and len(written) == blocks_ and not list(folder.parent.glob(f"{folder.name}-asked-*"))


def test_suffix_tree_leaves_few_bytes(spark):
    """Of what the tree has in the shared folder when it is scored: a token takes few bytes, a word's hash none."""
    rng = np.random.default_rng(3)
    words = np.minimum(rng.zipf(1.3, 60_000), 20_000)
    texts = [" ".join(f"w{w}" for w in part) for part in np.array_split(words, 60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    root = Path(suffix_tree.new_path(spark, "x").removeprefix("file://")).parent
    before = set(root.glob("tree-*"))
    scored = suffix_tree.suffix_tree_scores(docs, min_count=20, depth=3)
    made = set(root.glob("tree-*")) - before
    assert scored.count() == 60
    assert not [f.name for f in made if "hashes" in f.name or "asked" in f.name]
    assert sum(f.stat().st_size for folder in made if "files" in folder.name for f in folder.glob("*")) < 60_060 * 4.5


def test_suffix_tree_messages():
    rng = np.random.default_rng(5)
    total = np.concatenate([rng.zipf(1.5, 900), [0, 0, 5, 1 << 40]]).clip(0, 1 << 40).astype(np.int64)
    for least in (1, 20, 1 << 50):
        rank = suffix_tree._ranked(total, least)
        for some in (slice(None), slice(0, 300, 7), slice(0, 0)):
            x, i = suffix_tree._heard(suffix_tree.grow(suffix_tree.shrink(*suffix_tree._told(total[some], rank[some]))))
            assert x.tolist() == total[some].tolist() and i.tolist() == rank[some].tolist()
    runs = np.array([1, 700, 2, 1])
    word = np.concatenate([[9], np.sort(rng.integers(0, 1 << 33, 700)), [0, 0], [4]])
    starts = np.cumsum(runs) - runs
    arrays = suffix_tree.grow(suffix_tree.shrink(*suffix_tree._ascending(word, starts), np.zeros(0, np.uint8), np.packbits(word > 9)))
    assert suffix_tree._ascended(arrays[:2], runs).tolist() == word.tolist()
    assert len(arrays[2]) == 0 and np.unpackbits(arrays[3], count=len(word)).tolist() == (word > 9).tolist()
    key = rng.integers(0, 1 << 62, 500).astype(np.uint64)
    assert suffix_tree._order(key).tolist() == np.argsort(key).tolist()


@pytest.mark.parametrize("hot", [1e-3, 2e-2])
def test_suffix_tree_by_count(spark, rows, monkeypatch, hot):
    """Contexts by an absolute count, longer than two words, and closed under suffixes."""
    monkeypatch.setattr(suffix_tree, "HOT", hot)
    monkeypatch.setattr(suffix_tree, "pack_blocks", lambda *a: blocks.pack_blocks(*a, limit=3000))
    # "x q" tells no more than "q", but "p x q" and "s x q" do
    rows = [*rows, *((950 + i, " ".join(f"{a} x q {b}" for a, b in [("p", "u"), ("s", "v")] * 20) + " f g h i j" * 3, "a") for i in range(12))]
    end = b"\0end"
    texts = {i: [*split(t, True), end] for i, t, _ in rows}
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    count = collections.Counter(w for i, t in texts.items() if not held[i] for w in t)
    n, v = sum(count.values()), len(count)
    after = collections.defaultdict(collections.Counter)
    before = lambda t, k: [tuple(([end, *t])[k - d + 1 : k + 1]) for d in range(1, 4) if k - d + 1 >= 0]
    for i, t in texts.items():
        for k in range(len(t)) if not held[i] else ():
            for s in before(t, k):
                after[s][t[k]] += 1
    after[()] = count
    part = lambda c: {w: x / sum(c.values()) for w, x in c.items()}

    def diverges(s):
        q = part(after[s[1:]])
        return sum(after[s].values()) >= 6 and sum(p * math.log(p / q[w]) for w, p in part(after[s]).items()) >= suffix_tree.MIN_DIVERGENCE

    own = {s for s in list(after) if s and diverges(s)}
    tree = {s[k:] for s in own for k in range(len(s))}
    assert (b"x", b"q") in tree - own and (b"p", b"x", b"q") in own
    for i, r in by_id(suffix_tree.suffix_tree_scores(frame(spark, rows), min_count=6, depth=3)).items():
        t, score = texts[i], 0.0
        for k, w in enumerate(t):
            p = (count[w] + 1) / (n + v + 1)
            for s in before(t, k):
                if s in tree:
                    c = after[s]
                    p = (c[w] + len(c) * p) / (sum(c.values()) + len(c))
            score += math.log10(p)
        assert r["score"] == pytest.approx(score)


def test_toxicity(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(900):
        w = [rng.choice(words) for _ in range(rng.choice([5, 60]))]
        toxic = i % 6 == 0
        if toxic:
            w[rng.randrange(len(w))] = rng.choice(["Idiot,", "moron.", "SCUM"])
        rows.append((i, " ".join(w), "a"))
        labels.append((i, 1, int(toxic)))
    rows += [(5000, None, "a"), (5001, "", "a"), (None, "scum scum", None)]
    docs, lab = frame(spark, rows), spark.createDataFrame([*labels, (1, 0, None), (None, 0, 1), (0, 0, 0)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, lab)
    got = by_id(toxicity.score(docs, model))
    wrong = sum(got[i]["predicted"] != t for i, _, t in labels if got[i]["held_out"])
    assert wrong <= 2 and all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, _, _ in labels)
    assert got[5000]["score"] == got[5001]["score"] < 0.5 and got[None]["predicted"] == 1 and len(model.names) < 60
    clean = toxicity.keep_clean(docs, model)
    assert clean.columns == docs.columns and {r["doc_id"] for r in clean.collect()} == {i for i, r in got.items() if not r["predicted"]}


@pytest.mark.parametrize("l1", [20.0, 2.0])
def test_ftrl_by_the_plain_formulas(monkeypatch, l1):
    """Weights of the trainer against FTRL-proximal written feature by feature; with a small L1 those of single texts, too."""
    monkeypatch.setattr(toxicity, "L1", l1)
    rng = random.Random(11)
    labels = [int(rng.random() < 0.3) for _ in range(120)]
    texts = [sorted({rng.randrange(40) for _ in range(12)} | ({1000, 1001 + k} if y else {2000 + k % 3})) for k, y in enumerate(labels)]
    z, n, z0, n0 = collections.Counter(), collections.Counter(), 0.0, 0.0
    share = (sum(labels) + 0.5) / (len(labels) + 1)
    bias = start = math.log(share / (1 - share))

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((toxicity.BETA + math.sqrt(n[i])) / toxicity.ALPHA + toxicity.L2)

    for epoch in range(toxicity.EPOCHS):
        for k in np.random.default_rng(epoch).permutation(len(texts)):
            w = {i: weight(i) for i in texts[k]}
            p = 1 / (1 + math.exp(-(sum(w.values()) + bias)))
            g = (p - labels[k]) * (toxicity.TOXIC_WEIGHT if labels[k] else 1.0)
            for i in texts[k]:
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / toxicity.ALPHA * w[i]
                n[i] += g * g
            z0 += g - (math.sqrt(n0 + g * g) - math.sqrt(n0)) / toxicity.ALPHA * (bias - start)
            n0 += g * g
            bias = start - z0 / ((toxicity.BETA + math.sqrt(n0)) / toxicity.ALPHA)
    names, weights, got = toxicity.train([np.array(t, np.uint32) for t in texts], np.array(labels))
    assert dict(zip(names.tolist(), weights.tolist())) == pytest.approx({i: weight(i) for i in z if weight(i)}) and got == pytest.approx(bias)
    assert 1000 in names and (l1 > 16 or any(i > 1000 for i in names.tolist()))


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="no test tables")
def test_held_out_recall(spark):
    """Over nine tenths of the toxic documents that no label was learned from are found, and at most 6 of 1,200 clean ones."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    known = docs.join(labels.where("toxic IS NOT NULL").select("doc_id", "toxic"), "doc_id")
    rows = toxicity.score(known, toxicity.fit(docs, labels)).join(labels.select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    toxic, clean = ([r["predicted"] for r in rows if r["toxic"] == t] for t in (1, 0))
    assert len(toxic) > 100 and sum(toxic) > 0.9 * len(toxic) and sum(clean) <= 0.005 * len(clean)


def test_levels_of_features():
    """What a text repeats is a further feature, by the model as by the trainer."""
    col = pa.array(["a b", "a b a", "a x a y a"])
    found = toxicity.once(*toxicity.features(col), 3)
    extra = [set(f.tolist()) for f in found]
    a = next(iter(set(toxicity.features(pa.array(["a"]))[1].tolist())))
    marks = [a, *(a ^ int(m) for m in toxicity._LEVEL)]
    assert [[m in e for m in marks] for e in extra] == [[True, False, False], [True, True, False], [True, True, True]]
    names = np.array(sorted(marks), np.uint32)
    weights = np.array([{marks[0]: 1.0, marks[1]: 2.0, marks[2]: 4.0}[m] for m in names.tolist()])
    logit = lambda p: np.log(p / (1 - p))
    assert np.allclose(logit(toxicity.Model(names, weights, -3.0).scores(col)), [-2.0, 0.0, 4.0])


def test_toxicity_without_labels(spark, rows):
    docs = frame(spark, rows)
    model = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score(docs, model).where("score <> 0.5").count() == 0


def test_empty_tables(spark):
    e = frame(spark, [])
    path = tokenizer_path("byte_bpe_50k.json")
    for df in (bitplane.encode_and_read_back(spark, e, path), packing.pack(e, path), simhash.near_duplicates(e), simhash.near_duplicates(e, 4, distance=4), simhash.representatives(e), substrings.repeated_spans(e), substrings.remove_repeats(e), licenses.scan_licenses(e), mixing.mix(e), mixing.mixed_documents(e), suffix_tree.suffix_tree_scores(e), toxicity.score(e, toxicity.fit(e, spark.createDataFrame([], "doc_id long, toxic int")))):
        assert df.count() == 0
