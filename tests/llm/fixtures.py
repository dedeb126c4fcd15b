"""A small documents table with every awkward case, and brute-force helpers."""

import random
import re

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows(n=60, seed=5):
    r = random.Random(seed)
    vocab = ["".join(r.choices("abcdeéß", k=r.randint(1, 7))) for _ in range(400)]
    prose = lambda k: " ".join(r.choices(vocab, k=k)) + "."
    passage, out = prose(70), []
    for i in range(n):
        text = prose(r.choice([3, 40, 120, 300]))
        if i % 5 == 1:
            text = text[: len(text) // 2] + " " + passage + "\n" + text[len(text) // 2 :]
        if i % 7 == 3:
            text = out[-2][1]
        if i % 11 == 4 and out[-1][1]:
            ws = out[-1][1].split(" ")
            ws[len(ws) // 2] = "changed"
            text = " ".join(ws)
        out.append((i * 3 + 1, text or "", "en", f"s{i % 4}" if i % 9 else None, len(text or "")))
    out += [(500, None, None, None, None), (501, "", "en", "s1", 0), (502, " \t\n ", "en", "s1", 4), (None, out[1][1], "en", "s2", 1), (503, "a" * 500, "en", "s0", 500), (504, "ab" * 300, "en", "s0", 600), (505, "a" * 480, "en", "s0", 480)]
    out += [out[6], (out[6][0], out[8][1], "en", "s3", 5), (506, prose(4000), "de", "s3", 9), (507, "word", "en", "s0", 4), (508, "Word", "en", "s0", 4), (509, "A  b\tc", "en", "s2", 6), (510, "A b c", "en", "s2", 5)]
    return out


def frame(spark, data=None):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows() if data is None else data, SCHEMA)
    # extra columns, named as the operators name their own
    return df.withColumns({c: F.lit(7) for c in ("did", "tag", "runs", "part", "kept", "size", "score", "text_sha256", "copies", "_did", "_th", "_in", "_source", "_copies", "_times")}).repartition(3)


def key(x):
    return (x is None, x or 0)
