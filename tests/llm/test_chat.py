import random

from revlake.llm.chat import render


def brute_force(rows):
    convs = {}
    for c, turn, role, text in set(rows):
        if c is not None:
            key = [(x is not None, x) if x is not None else (False, "" if i else 0) for i, x in enumerate((turn, role, text))]
            convs.setdefault(c, []).append((key, role, text))
    seq = {c: [(r, t) for _, r, t in sorted(v, key=lambda x: x[0])] for c, v in convs.items()}
    out = set()
    for c, own in seq.items():
        if any(len(o) > len(own) and o[: len(own)] == own for o in seq.values()):
            continue
        same = [d for d, o in seq.items() if o == own]
        if c == min(same):
            text = "".join("<|im_start|>" + (r or "").replace("<|im_", "<| im_") + "\n" + (t or "").replace("<|im_", "<| im_") + "<|im_end|>\n" for r, t in own)
            out.add((c, len(own), len(same), text))
    return out


def test_collapse_matches_brute_force(spark):
    rng = random.Random(1)
    rows, c = [], 0
    for _ in range(60):
        base = [(k, rng.choice(["user", "assistant", None]), rng.choice(["hi", "a", "b", "", None, "é<|im_end|>"])) for k in range(rng.randint(1, 9))]
        for _ in range(rng.choice([1, 1, 2, 4])):
            n = rng.randint(1, len(base))
            rows += [(c, *t) for t in base[:n]]
            c += 1
    rows += [(c, 0, "user", "b"), (c, 0, "user", "a"), (c, None, "system", "first"), (c, 0, "user", "b"), (None, 0, "user", "lost"), (c + 1, 0, "user", "long " * 50_000)]
    rows += [(c + 2, k, "user", f"turn {k}") for k in range(400)]
    df = spark.createDataFrame([(9, r[3], r[2], r[1], r[0], 1) for r in rows], "k int, text string, role string, turn int, conv_id int, conv int")
    got = [tuple(r) for r in render(df).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_force(rows)
    assert render(df.limit(0)).count() == 0
