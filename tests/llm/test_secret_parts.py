"""Secrets behind prefixes, beside placeholders, and without digits."""

from __future__ import annotations

import random
import re
import string
from collections import Counter
from math import log2

from sparkmart.llm import secret_scan


def brute_force(text):
    found = []
    for run in re.finditer(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}", text):
        own, pieces, at = run[0], [], 0
        for allowed in re.finditer(secret_scan.ALLOWED_PARTS, own):
            pieces.append((at, allowed.start()))
            at = allowed.end()
        for a, b in [*pieces, (at, len(own))]:
            hits = []
            for i in range(a, b - 19):
                part = own[i : i + 20]
                least = 3.7
                if re.search("[0-9]", own[a:b]) and re.fullmatch("[0-9a-fA-F]+", part):
                    least = 3.0
                if -sum(c / 20 * log2(c / 20) for c in Counter(part).values()) >= least - 1e-9:
                    hits.append(i)
            if hits:
                found.append((run.start() + hits[0], run.start() + hits[-1] + 20))
    return found


def test_entropy_by_part_matches_brute_force(spark):
    rng = random.Random(9)
    draw = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    texts = [None, "", "12345678-1234-1234-1234-1234567890ab id=12345678-1234-1234-1234-1234567890ab"]
    texts += ["2024/01/02/1234567890123456 x=1212-3434-5656-7878-9090 " + "ab" * 30 + " " + "-" * 50]
    keys = [f"id={draw('0123456789ABCDEF', n)}" for n in (20, 32, 40) for _ in range(20)]
    letters = [draw(string.ascii_letters, 40) for _ in range(20)]
    beside = [f"example_{draw(string.ascii_letters + string.digits, 40)}" for _ in range(20)]
    parts = ["key=", "/", "-", "_", " ", "é", "example", "DUMMY", "xxxxxxx", "0123456789", "abcdefghijkl", "7",
             "04DBEBAB91AB85687D33", "04dbebab91ab85687d33e", "Qx7Lp2Vn9Tz4Rk8Ws1", "QxzLpkVnhTzjRkuWse"]
    texts += keys + letters + beside
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    scanned = secret_scan.scan(df, by_part=True)
    got = {r["doc_id"]: [(s["start"], s["end"]) for s in r["secrets"] if s["kind"] == 3] for r in scanned.collect()}
    for i, text in enumerate(texts):
        assert got[i] == brute_force(text or "")
    found = [bool(got[i]) for i, t in enumerate(texts) if t in keys + letters + beside]
    assert sum(found) / len(found) > 0.95
    assert not got[2] and not got[3]
    plan = scanned._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
