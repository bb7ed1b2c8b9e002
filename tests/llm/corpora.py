"""Small document tables with what real ones hold: nulls, copies, odd texts."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, words string, block long, "
          "row long, set_id string, score string, kept string, number int, h string, text_odds string")


def sentence(rng, n, letters="abcdefghij"):
    return " ".join("".join(rng.choices(letters, k=rng.randint(2, 7))) for _ in range(n))


def texts(seed=1):
    rng = random.Random(seed)
    passage = sentence(rng, 70)
    base = sentence(rng, 300)
    found = [None, "", " ", "\n\t \r\n", "x", "A b", "one two three", "don't  stop now   \x1c x²½Ⅷ",
             "日本語のテキスト です", "🙂🙂 emoji 🙂", "\x00 nul \x00 byte", "ab " * 400, "z" * 3000, "é" * 60,
             "The THE the THE the the\nsame line\nsame line\n\nsame line", base, base, base.upper(),
             base.replace("a", "a", 1) + " tail", passage + " " + sentence(rng, 40),
             sentence(rng, 60) + "\n" + passage + "\n" + sentence(rng, 30), sentence(rng, 20) + " " + passage,
             "All rights reserved. Licensed under CC BY-NC 4.0. All Rights Reserved",
             "this work is licensed under the GNU General Public License, version 3."]
    words = base.split()
    for k in range(12):  # near copies
        copy = words[:]
        for _ in range(k):
            copy[rng.randrange(len(copy))] = sentence(rng, 1)
        found.append(" ".join(copy))
    found += [sentence(rng, rng.randint(1, 120)) for _ in range(25)]
    return found


def rows(seed=1):
    out = []
    for i, text in enumerate(texts(seed)):
        lang = [None, "en", "de"][i % 3]
        out.append((i * 7 % 101, text, lang, None if i % 5 == 0 else f"s{i % 4}", None if text is None else len(text)))
    out.append(out[15])  # a repeated row
    out.append((None, out[15][1], None, None, None))  # without id
    out.append((None, None, None, None, None))
    return out


def documents(spark, data, partitions=3):
    clash = ("w", 1, 2, "s", "s", "k", 3, "h", "o")
    return spark.createDataFrame([(*r, *clash) for r in data], SCHEMA).repartition(partitions, "n_chars") \
        if data else spark.createDataFrame([], SCHEMA)


def stored(spark, data, path):
    """As a file, whose repeated scans give the same rows in the same order."""
    documents(spark, data).write.parquet(str(path))
    return spark.read.parquet(str(path))
