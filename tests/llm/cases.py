"""Small tables that hold every awkward case at once."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def lower(text):
    return (text or "").translate(_LOWER)


def words(text):
    return WORD.findall(text or "")


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice("ab cd ef gh ij kl mn op qr st uv wx yz Éa öb".split()) + str(rng.randrange(60)) for _ in range(n))


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, node string, text_key string, size string, n string, score string, copy string, bad string, rank string, whole string, w string, own string, line string, site string"


def awkward_rows():
    """(doc_id, text, lang, source, n_chars) with nulls, copies, near copies, long texts."""
    base = prose(1, 120)
    near = base.split(" ")
    rows = [
        (1, base, "en", "s1", 5), (2, base, "en", "s2", 5), (2, base, "en", "s2", 5),
        (3, base.upper(), "en", None, None), (None, base, "de", "s1", 1), (None, None, None, None, None),
        (4, None, "en", "s1", 0), (5, "", "en", "s1", 0), (6, " \t\n ", None, "s1", 4),
        (7, "one", "en", "s3", 3), (8, "one", "fr", "s3", 3), (9, "two words", "fr", "s3", 9),
        (10, prose(2, 4000), "en", "s2", 9), (11, "x" * 5000, "en", "s2", 5000),
        (12, "again and again " * 40, "en", "s1", 1), (12, "other text of the same id " + prose(5, 30), "en", "s1", 1),
    ]
    for k in range(8):
        edited = list(near)
        for j in range(k):
            edited[(17 * (j + 1) + 7 * k) % len(edited)] = f"edit{k}-{j}"
        rows.append((20 + k, " ".join(edited), "en", f"s{k % 3}", 1))
    for k in range(6):
        rows.append((40 + k, prose(50 + k, 45) + "\n" + prose(99, 50) + "\n" + prose(60 + k, 30), "de", "s4", 1))
    return rows


def awkward(spark, rows=None):
    rows = awkward_rows() if rows is None else rows
    return spark.createDataFrame([(*r, *["clash"] * 14) for r in rows], SCHEMA)
