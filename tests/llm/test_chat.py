"""Preference formatting against plain Python."""

import random

from slotflow.llm import chat


def plain(turns, pairs):
    """[(pair_id, part, turn, content, begin, loss_begin)] from (conv_id, turn, role, text)."""
    convs = {}
    for c, t, role, text in turns:
        if c is not None and t is not None:
            old = convs.setdefault(c, {}).get(t)
            new = (role or "", text or "")
            convs[c][t] = min(old, new) if old else new
    out = []
    for pair, chosen, rejected in pairs:
        a, b = convs.get(chosen), convs.get(rejected)
        if not a or not b:
            continue
        split = min((t for t in a.keys() | b.keys() if a.get(t) != b.get(t)), default=None)
        parts = {"prompt": {t: x for t, x in a.items() if split is None or t < split}}
        for side, conv in (("chosen", a), ("rejected", b)):
            parts[side] = {t: x for t, x in conv.items() if split is not None and t >= split}
        for part, own in parts.items():
            at = 0
            for t in sorted(own):
                role, text = own[t]
                content = f"<|{role}|>\n{text}<|end|>\n"
                out.append((pair, part, t, content, at, at + 5 + len(role) if part != "prompt" and role == "assistant" else None))
                at += len(content)
    return sorted(out, key=str)


def run(spark, turns, pairs):
    t = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, side string, pair_id string" if turns and len(turns[0]) == 6 else "conv_id long, turn long, role string, text string")
    p = spark.createDataFrame([(k, c, s) for k, a, b in pairs for c, s in ((a, "chosen"), (b, "rejected"))], "pair_id long, conv_id long, side string")
    rows = chat.format_pairs(t, p).collect()
    assert all(r.end == r.begin + len(r.content) and (r.loss_end is None or r.loss_end == r.end) for r in rows)
    return sorted(((r.pair_id, r.part, r.turn, r.content, r.begin, r.loss_begin) for r in rows), key=str)


def test_random_pairs(spark):
    rng = random.Random(6)
    turns, pairs = [], []
    for p in range(60):
        shared = [(rng.choice(["user", "assistant", "system"]), rng.choice(["hi", "é🙂", "", "long text"])) for _ in range(rng.randint(0, 4))]
        for c in (2 * p, 2 * p + 1):
            own = shared + [(rng.choice(["user", "assistant"]), rng.choice(["x", "y"])) for _ in range(rng.randint(0, 3))]
            turns += [(c, t * 2, role, text) for t, (role, text) in enumerate(own)]
        pairs.append((p, 2 * p, 2 * p + 1))
    assert run(spark, turns, pairs) == plain(turns, pairs)


def test_edge_rows(spark):
    turns = [(0, 0, "user", "q"), (0, 0, "user", "q"), (1, 0, "user", "q"), (0, 1, None, None), (1, 1, "assistant", "b"), (1, 1, "assistant", "a"),
             (2, 0, "user", "only"), (None, 0, "user", "x"), (3, None, "user", "x"), (4, 0, "a", "s"), (5, 0, "a", "s"), (6, 7, "assistant", "s"), (7, 8, "assistant", "s")]
    pairs = [(0, 0, 1), (1, 2, 3), (2, 4, 5), (3, 6, 7)]
    assert run(spark, turns, pairs) == plain(turns, pairs)
    assert run(spark, [], pairs) == []


def test_neighbours(spark):
    df = spark.createDataFrame([(c,) for c in (-3, -2, 0, 1, 5, None, 1)], "conv_id long")
    assert sorted((r.pair_id, r.conv_id, r.side) for r in chat.neighbours(df).collect()) == [(-2, -3, "rejected"), (-1, -2, "chosen"), (0, 0, "chosen"), (0, 1, "rejected"), (2, 5, "rejected")]
