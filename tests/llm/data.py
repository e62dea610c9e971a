"""Small tables with all that is awkward, and brute-force rules to hold operators against."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def folded(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    r = random.Random(seed)
    return " ".join("w" + "abcdefgh"[x % 8] * (1 + x % 3) + str(x) for x in (r.randrange(vocabulary) for _ in range(n)))


def documents() -> list[tuple]:
    """(doc_id, text, source): exact and near copies, a shared passage, repeated lines, nulls, empty and long texts, repeated rows."""
    base, passage = prose(1, 300), prose(2, 60)
    words = base.split()
    rows = [(10, base, "a"), (3, base, "a"), (11, base, None)]
    for i in range(25):  # near copies of one text, by one or two changed words, on both sides of the threshold
        w = list(words)
        for k in range(1 + i % 4):
            w[(37 * i + 71 * k) % len(w)] = f"edit{i}x{k}"
        rows.append((100 + i, "  ".join(w) if i % 2 else "\n".join(w), "a"))
    for i in range(12):
        rows.append((200 + i, f"{prose(50 + i, 40 + i)}\n{passage}\t{prose(80 + i, 20)}", "b" if i % 2 else "a"))
    for i in range(8):
        rows.append((300 + i, f"Subscribe to our page\n{prose(120 + i, 30)}\n  Subscribe to our page \n\n", "b"))
    rows += [(400, None, "a"), (401, "", "b"), (402, " \n\t ", None), (403, "One two", "c"), (404, "one TWO", "c"), (405, "x", "c"), (406, "aé　b\xa0c " * 50, "é")]
    rows += [(407, " ".join(["again"] * 200), "a"), (408, prose(7, 6000, 3000), "c"), (409, prose(7, 6000, 3000) + " end", "c"), (410, "y" * 100_000 + " " + passage, "c")]
    rows += [(None, prose(9, 50), "a"), (None, base, None), (412, prose(10, 45), "b"), (412, prose(10, 45), "b"), (413, prose(11, 45), "b")]
    return rows


def frame(spark, rows: list[tuple] | None = None, parts: int = 5):
    """Documents with extra columns whose names clash with the operators' own."""
    from pyspark.sql import functions as F

    rows = documents() if rows is None else rows
    schema = "doc_id bigint, text string, source string"
    out = spark.createDataFrame(rows, schema).repartition(parts)
    extra = ("row", "key", "id", "node", "size", "token", "root", "host", "n_words", "n_removed", "kept", "hit_spans", "slot", "src", "drop", "spans", "score", "lang_pred", "pii", "main_text")
    return out.withColumns({c: F.lit(f"own {c}") for c in extra})
