"""The prefix trie against one made of whole turns in plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest

from tabularium.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, place long, depth long, f1 string, n_own int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x", 3) for r in rows], SCHEMA)


def brute(rows):
    def ref(role, text):
        return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()

    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own.setdefault(conv, []).append(((turn is not None, turn or 0, role, ref(role, text)), role, text))
    own = {c: [t[1:] for t in sorted(turns, key=lambda t: t[0])] for c, turns in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - c % 20 if c >= 0 else c + -c % 20
        whole[c] = own.get(base, [])[:h] + turns[h:]
    members = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    words = {n: len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0 for n in members}
    out = Counter()
    below = {n: [m for m in members if m[: len(n)] == n] for n in members}
    children = Counter(n[:-1] for n in members if n)
    for n, cs in members.items():
        ends = ",".join(str(c) for c in sorted(cs) if len(whole[c]) == len(n))
        out[
            min(cs), len(n), min(members[n[:-1]]) if n else None, len(cs), children[n], sum(not children[m] for m in below[n]),
            sum((len(members[m]) - 1) * words[m] for m in below[n]), hashlib.sha256(ends.encode()).hexdigest(),
        ] += 1
    return out


def got(frame):
    return Counter(tuple(r) for r in prefix_trie.nodes(frame).collect())


@pytest.mark.parametrize("seed", range(3))
def test_equals_plain_version(spark, seed):
    rng = random.Random(seed)
    rows = [(c, t, rng.choice(["user", "bot"]), "say " * rng.randint(0, 2) + "so") for c in range(130) for t in range(rng.randint(1, 6))]
    rng.shuffle(rows)
    assert got(table(spark, rows).repartition(7)) == brute(rows)


def test_awkward_conversations(spark):
    rows = [(c, t, "user", "same") for c in range(40, 75) for t in range(3)]  # copies
    rows += [(c, 0, None, None) for c in (81, 82, 83, 84)] + [(85, 0, "", "")]  # null is empty; some are turnless without a base
    rows += [(90, None, "user", "first"), (90, 2, "a", "x"), (90, 2, "a", "x"), (90, 2, "a", "w"), (90, 2, "b", "v"), (90, None, "user", "first")]  # ties, repeats
    rows += [(None, 0, "user", "nobody"), (-3, 0, "u", "neg"), (-3, 1, "u", "neg"), (-25, 4, "u", "neg"), (0, 0, "u", "neg")]
    rows += [(100, t, "user", f"{t % 3} " * 4) for t in range(400)] + [(t, 9, "u", "long " * 30_000) for t in (101, 102)]
    assert got(table(spark, rows).repartition(4)) == brute(rows)
    assert got(table(spark, rows).limit(0)) == Counter()


def test_one_conversation_over_many_tasks(spark):
    rows = [(20, t, "user", f"turn {t}") for t in range(300)] + [(c, t, "user", f"turn {t}") for c in (21, 22, 26) for t in range(5)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert got(table(spark, rows).repartition(6)) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_equal_fingerprints_of_different_turns_are_noticed(spark, monkeypatch):
    rows = [(c, t, "user", f"turn {t} {c % 5}") for c in range(30) for t in range(4)]
    values = prefix_trie.turn_value
    monkeypatch.setattr(prefix_trie, "multiplier", lambda attempt: 3)
    members = table(spark, rows)
    turns = prefix_trie.stage(prefix_trie._turns(members), "turns")
    scan = prefix_trie.stage(prefix_trie._scan(turns, 3), "products")
    placed = prefix_trie._placed(scan, prefix_trie._carried(scan, 3))
    found = prefix_trie._members(placed, prefix_trie._conversations(placed, 3), 3)
    assert prefix_trie._nodes(found)[1]
    clash = found.withColumn("f1", found["f1"] * 0).withColumn("f2", found["f2"] * 0)
    assert not prefix_trie._nodes(clash)[1]
    assert values(b"\x01" * 32) < prefix_trie.PRIME


def test_halves_keep_all_bits():
    for x in (0, 1, 1 << 63, (1 << 64) - 1, 1 << 64, prefix_trie.PRIME - 1):
        high, low = prefix_trie._halves(x)
        assert (high << 64) + (low % (1 << 64)) == x and -(1 << 63) <= low < 1 << 63
