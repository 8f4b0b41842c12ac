"""The operators that remove, link and measure, against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import xxhash

from sparkmart.llm import merge_runs, quality_rules, simhash, substring_dedup, suffix_dedup

WORD = r"[^\x20\x09-\x0D]+"


def corpus(seed, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["é", "ß😀"]
    passage = " ".join(rng.choice(vocabulary) for _ in range(30))
    out = []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.3:
            words.insert(rng.randint(0, len(words)), passage)
        text = "".join(w + rng.choice([" ", "\n", "  "]) for w in words)
        out.append((i, text))
        if rng.random() < 0.2:
            out.append((1000 + i, text))
    return out


def docs_of(spark, rows, parts=5):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)


def test_substring_dedup_matches_brute_force(spark):
    rows = corpus(1)
    words = {i: re.findall(WORD, t) for i, t in rows}
    first = {}
    for i in sorted(words):
        for k in range(len(words[i]) - 12):
            first.setdefault(tuple(words[i][k : k + 13]), i)
    expected = set()
    for i, own in words.items():
        gone = [False] * len(own)
        for k in range(len(own) - 12):
            if first[tuple(own[k : k + 13])] < i:
                gone[k : k + 13] = [True] * 13
        kept = " ".join(w for w, g in zip(own, gone, strict=True) if not g)
        expected.add((i, len(own), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    got = substring_dedup.remove_repeats(docs_of(spark, rows))
    assert {tuple(r) for r in got.collect()} == expected
    assert any(r[2] for r in expected)


def test_substring_dedup_edges(spark, edge, empty):
    got = sorted(map(tuple, substring_dedup.remove_repeats(edge, with_text=False).collect()), key=str)
    assert len(got) == 8
    removed = {r[0]: r[2] for r in got}
    assert removed[None] == removed[7] == removed[11] == removed[10] == 0
    assert substring_dedup.remove_repeats(empty).count() == 0


def test_merge_of_front_coded_runs():
    rng = random.Random(2)
    for _ in range(300):
        runs = [
            sorted(
                bytes(rng.choice(b"ab") for _ in range(rng.choice([0, 2, 5, 90])))
                for _ in range(rng.randint(0, 12))
            )
            for _ in range(rng.randint(0, 9))
        ]
        coded, base = [], 0
        for run in runs:
            names = np.arange(base, base + len(run))
            coded.append(merge_runs.front_coded(*merge_runs.front_code(run), names))
            base += len(run)
        out = list(merge_runs.merge(coded))
        assert [s for _, s, _ in out] == sorted(s for run in runs for s in run)
        assert sorted(n for _, _, n in out) == list(range(base))
        for a, b in zip(out, out[1:], strict=False):
            assert b[0] == merge_runs.common_prefix(a[1], b[1])


def brute_bytes(rows, length):
    raw = [(i, (t or "").encode()) for i, t in rows]
    counts = Counter(b[k : k + length] for _, b in raw for k in range(len(b) - length + 1))
    out = []
    for i, b in raw:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if counts[b[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_suffix_dedup_matches_brute_force(spark):
    rng = random.Random(3)
    pieces = ["ab" * 100, "a" * 300, "the quick brown fox ", "é" * 50, "xyz" * 60, "lorem ipsum " * 7]
    rows = [
        (i, "".join(rng.choice(pieces) + rng.choice("0123456789") for _ in range(rng.randint(0, 12))))
        for i in range(80)
    ]
    rows += [(500, None), (501, ""), (502, "q" * 1000), (502, "q" * 1000), (503, "z" * 400), (504, "w" * 401)]
    got = suffix_dedup.remove_repeats(docs_of(spark, rows), 400, with_text=False)
    assert sorted(map(tuple, got.collect())) == brute_bytes(rows, 400)


def test_suffix_dedup_reads_long_texts_in_parts(spark, monkeypatch):
    rng = random.Random(4)
    part = "".join(rng.choice("abcdefgh") for _ in range(3000))
    rows = [(1, part + "x" + part[:1500]), (2, "y" + part[700:1400])]
    data, offsets = np.frombuffer(rows[0][1].encode(), np.uint8), np.array([0, 4501])
    monkeypatch.setattr(suffix_dedup, "_LONG", 1000)
    import pyarrow as pa

    hashes, _, places = suffix_dedup._anchor_hashes(400)(pa.array([rows[0][1]]))
    whole = suffix_dedup._anchors(data, offsets, 400)
    assert set(whole[1].tolist()) <= set(places.tolist())
    got = suffix_dedup.remove_repeats(docs_of(spark, rows, 2), 400, with_text=False)
    assert sorted(map(tuple, got.collect())) == brute_bytes(rows, 400)


def test_suffix_dedup_edges(spark, edge, empty):
    got = {r[0]: r[2] for r in suffix_dedup.remove_repeats(edge, with_text=False).collect()}
    assert got[None] == got[7] == got[8] == 0 and got[10] == 200_000
    assert suffix_dedup.remove_repeats(empty).count() == 0


def brute_simhash(rows, radius=4):
    prints = {}
    for i, text in rows:
        words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
        shingles = [b" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    label = dict(zip(prints, prints, strict=True))
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= radius and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return {(i, f"{p:016x}", label[i]) for i, p in prints.items()}


def test_simhash_matches_brute_force(spark):
    rng = random.Random(5)
    rows = corpus(5, 30) + [(5000, None), (5001, "Only Two"), (5002, "only two")]
    base = [f"v{k}" for k in range(200)]
    for i in range(30):
        own = base.copy()
        for _ in range(rng.randint(0, 6)):
            own[rng.randrange(200)] = f"z{rng.randrange(9)}"
        rows.append((6000 + i, " ".join(own)))
    got = {tuple(r) for r in simhash.near_duplicates(docs_of(spark, rows)).collect()}
    assert got == brute_simhash(rows)


def test_simhash_splits_large_cells(spark, monkeypatch):
    rng = random.Random(6)
    prints = {rng.getrandbits(13) for _ in range(400)} | {0, 1, 3}
    monkeypatch.setattr(simhash, "TILE", 16)
    monkeypatch.setattr(simhash, "TILES_PER_TASK", 2)
    frame = spark.createDataFrame([(p,) for p in prints], "print long")
    edges = [tuple(r) for r in simhash.near_edges(frame, 4).collect()]
    assert all((u ^ v).bit_count() <= 4 for u, v in edges)

    def groups(links):
        label = {p: p for p in prints}
        changed = True
        while changed:
            changed = False
            for u, v in links:
                low = min(label[u], label[v])
                if label[u] != low or label[v] != low:
                    label[u] = label[v] = low
                    changed = True
        return label

    every = [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 4]
    assert groups(edges) == groups(every)


def test_simhash_edges(spark, edge, empty):
    got = simhash.near_duplicates(edge).collect()
    assert len(got) == 8
    assert {r["component_id"] for r in got if r["fingerprint"] == "0" * 16} == {7}
    assert simhash.near_duplicates(empty).count() == 0


def test_quality_measures_match_brute_force(spark, empty):
    rows = [(i, t * (1 + i % 3) + "\n# a | b\n# a | b\n") for i, t in corpus(7, 20)] + [(900, None), (901, "")]
    got = {r["doc_id"]: r for r in quality_rules.judge(docs_of(spark, rows)).collect()}
    for i, text in rows:
        words, seen, dup = re.findall(WORD, text or ""), set(), 0
        for line in (text or "").split("\n"):
            if re.search(WORD, line):
                dup += line in seen
                seen.add(line)
        windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
        counts, repeated = Counter(windows), [False] * len(words)
        for k, w in enumerate(windows):
            if counts[w] > 1:
                repeated[k : k + 8] = [True] * 8
        expected = (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, sum(repeated),
            len(words) < 20 or 100 * sum(repeated) > 30 * len(words),
        )
        r = got[i]
        assert expected == (
            r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"],
        )
        assert not (r["base_failed"] and r["kept"])
    assert quality_rules.judge(empty).count() == 0


def test_em_recovers_accuracies():
    rng = random.Random(8)
    truth, votes = [0.95, 0.8, 0.7], Counter()
    for _ in range(20_000):
        good = rng.random() < 0.7
        pattern = tuple(
            0 if rng.random() < 0.2 else (1 if good == (rng.random() < a) else -1) for a in truth
        )
        votes[pattern] += 1
    prior, accuracy = quality_rules.estimate(sorted(votes.items()))
    assert abs(prior - 0.7) < 0.05
    assert all(abs(a - t) < 0.06 for a, t in zip(accuracy, truth, strict=True))
    assert quality_rules.estimate([]) == (0.5, [])
