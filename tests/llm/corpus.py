"""Small tables with the cases that every operator has to define."""

import random

DOCS = "doc_id long, text string, lang string, source string, rk string, size long"
AKIA = "AKIA" + "ABCDEFGH12345678"


def documents(n: int = 60, seed: int = 1) -> list[tuple]:
    """(doc_id, text, lang, source, and two columns whose names operators use inside)."""
    r = random.Random(seed)
    words = [f"{a}{b}" for a in ("ba", "ko", "ti", "mu", "re") for b in ("lan", "der", "sos", "pim", "quo")]
    shared = " ".join(r.choice(words) for _ in range(60))
    rows = []
    for i in range(n):
        text = " ".join(r.choice(words) + r.choice(("", "", ",", ".")) for _ in range(r.randint(1, 120)))
        if i % 4 == 0:
            text += "\n" + shared + "\nEnd Of Page  "
        if i % 9 == 0 and i:
            text = rows[-1][1] or ""
        rows.append((i * 3, text, ("en", "fr")[i % 2], f"s{i % 3}" if i % 7 else None, "x", 1))
    odd = ["", None, "   \t\n ", "one", "a a a a a a a a a a a a a a a a a a a a a a a a a a", "É ß \x1c İ ΣΑΣ 🙂 ½", f'password = "{"q1" * 9}" {AKIA} deadbeefdeadbeef', "\n\n", "123 456"]
    rows += [(1000 + i, t, "en", "s1", None, None) for i, t in enumerate(odd)]
    rows.append((2000, " ".join(r.choice(words) for _ in range(9000)), "en", "s0", "y", 2))  # very long
    rows += [rows[4], rows[4]]  # repeated rows
    rows.append((None, rows[8][1], None, "s2", "z", 3))
    return rows


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema).repartition(3)


def lower(t: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
