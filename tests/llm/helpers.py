"""Small tables with every awkward row, and plain versions of what the operators compute."""

import random
import re
from collections import Counter

from pyspark.sql import DataFrame, SparkSession

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = """doc_id bigint, text string, lang string, source string, n_chars bigint, id string, kept string, node int,
    n_words string, score string, label int, row int, c0 string"""


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def prose(rnd: random.Random, n: int, vocabulary: int = 400) -> str:
    out = [f"w{rnd.randrange(vocabulary)}" for _ in range(n)]
    for i in range(7, n, 12):
        out[i] += ".\n" if i % 3 else ". "
    return " ".join(out) + "."


def edge_texts(seed: int = 1) -> list[tuple[int | None, str | None]]:
    """Documents with copies, near-copies, shared passages, empty, NULL, short, very long and non-ASCII texts, tabs,
    form feeds and no-break spaces, repeated ids and NULL ids."""
    rnd = random.Random(seed)
    passage = prose(rnd, 70)
    rows: list[tuple[int | None, str | None]] = [
        (1, None),
        (2, ""),
        (3, " \t\n\x0b\x0c\r "),
        (4, "one two"),
        (5, "ONE two"),
        (6, "É x ñandú ß 東京 Σας İÍ é"),
        (7, "x" * 3000),
        (8, "a " * 300),
        (9, "a " * 290 + "b"),
        (10, prose(rnd, 25_000, 4000)),
        (None, prose(rnd, 80)),
        (None, None),
        (11, "# $ % | < > | |\nHome | About | Contact\n" + prose(rnd, 40)),
        (12, "don't we'll <|endoftext|> foo<|startoftext|>bar's \x01 \x00 it's 12345 a1b2"),
    ]
    for i in range(20, 50):
        rows.append((i, prose(rnd, rnd.randrange(1, 200))))
    for i in range(50, 60):
        rows.append((i, prose(rnd, 30) + " " + passage + " " + prose(rnd, 30)))
    base = prose(rnd, 150).split(" ")
    for i in range(60, 90):
        changed = list(base)
        for _ in range(rnd.choice([0, 0, 1, 2, 3, 5])):
            changed[rnd.randrange(len(changed))] = f"new{rnd.randrange(10**6)}"
        rows.append((i, " ".join(changed)))
    rows += [(90, rows[20][1]), (90, rows[20][1]), (91, rows[21][1]), (91, rows[22][1] + " more")]
    return rows


def documents(spark: SparkSession, texts: list[tuple[int | None, str | None]]) -> DataFrame:
    rows = [
        (i, t, ("en", "de", None)[n % 3], f"s{n % 2}" if n % 5 else None, len(t or ""), "x", "y", n, "z", "q", n, n, "c")
        for n, (i, t) in enumerate(texts)
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def components(nodes: list, links: list[tuple]) -> dict:
    """The smallest node that each node reaches."""
    parent = {node: node for node in nodes}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        low, high = sorted((top(a), top(b)))
        parent[high] = low
    return {node: top(node) for node in nodes}


def as_counter(df: DataFrame, *columns: str) -> Counter:
    return Counter(tuple(row) for row in df.select(*columns).collect())
