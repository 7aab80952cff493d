"""Small tables with the awkward rows every operator has to stand."""

import random
import re

WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# Extra columns whose names operators might use themselves.
EXTRA = ["key", "keys", "label", "version", "lines", "dropped", "part", "text_hash", "v1", "start", "node"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in EXTRA)


def frame(spark, rows, parts=3):
    """Documents of (doc_id, text[, lang]) rows, with extra columns of clashing names."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", len(r[1] or ""), *["x"] * len(EXTRA)) for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


def sentence(draw, n, words="the of and to Stone river light über café zwölf mañana seven eight quick brown".split()):
    return " ".join(draw.choice(words) + draw.choice(["", "", "", "s", "ed", "er", "ly"]) for _ in range(n))


def corpus(seed, n=60):
    """Different, equal and nearly equal texts, shared passages, nulls, empty and long ones, repeated rows."""
    draw = random.Random(seed)
    passage = sentence(draw, 70)
    rows = [(i, "\n".join(sentence(draw, draw.randint(1, 30)) for _ in range(draw.randint(1, 5)))) for i in range(n)]
    rows += [(100 + i, sentence(draw, 12) + " " + passage + " " + sentence(draw, draw.randint(3, 12))) for i in range(6)]
    base = sentence(draw, 120).split()
    for i in range(8):  # near copies: a few words differ
        words = list(base)
        for _ in range(i):
            words[draw.randrange(len(words))] = sentence(draw, 1)
        rows.append((200 + i, " ".join(words)))
    rows += [(300, rows[3][1]), (301, rows[3][1].upper()), (302, rows[5][1]), (302, rows[5][1])]
    rows += [(400, None), (401, ""), (402, " \n\t "), (403, "one"), (404, "One"), (405, "..."), (406, None)]
    rows += [(500, sentence(draw, 3000)), (501, "word " * 500), (502, "a" * 900), (-7, sentence(draw, 9))]
    return rows
