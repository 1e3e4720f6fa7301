from __future__ import annotations

import random

SMALL = "/root/testdata/sf0.001"
# Extra columns whose names the operators use themselves.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, key string, row string, "
    "n_words string, chunk string, bucket string, band string, component string, failures string"
)


def texts() -> list[tuple[int | None, str | None]]:
    """Ids and texts: nulls, empty, blank, very long, near and exact copies, repeated rows."""
    r = random.Random(3)
    vocabulary = ["".join(r.choice("abcdefghij") for _ in range(r.randrange(2, 9))) for _ in range(400)]

    def prose(n):
        return " ".join(r.choice(vocabulary) for _ in range(n))

    passage = prose(60)
    base = prose(120).split(" ")
    near = base.copy()
    near[7] = "changed"
    out = [
        (5, None), (6, ""), (7, " \t\n\x0b "), (8, "one two"), (9, "ONE  two"), (10, "one two three four five"),
        (11, " ".join(base)), (12, " ".join(near)), (13, " ".join(base).upper()), (14, " ".join(base)),
        (20, prose(200) + "\n" + passage + "\n" + prose(50)), (21, prose(30) + passage + prose(30)),
        (22, passage + " " + passage), (23, "x" * 5000), (24, "x" * 300), (25, prose(3000)),
        (26, "naïve 中文 ﬁn ▁ <|endoftext|> don't I'LL 𐵀\x00 é"), (27, "é" * 150 + "中" * 90),
        (None, prose(40)), (None, prose(40)), (None, None), (30, prose(25)), (30, prose(25)),
        (31, " ".join(base)), (31, " ".join(base)), (32, "#$ " * 40), (33, ("word again and on " * 20)),
        (34, "line one is here\n" * 30), (35, "SHOUT LOUD " * 30), (36, "a,, b.. c! d?! " * 12),
    ]
    return out + [(40 + k, prose(r.randrange(1, 90))) for k in range(20)]


def ordered(rows) -> list[tuple[int | None, str]]:
    """Rows in the order in which operators number them: null ids last, then by text."""
    return sorted(((i, t or "") for i, t in rows), key=lambda x: (x[0] is None, x[0] or 0, x[1].encode()))
