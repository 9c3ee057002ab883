"""Small inputs with every awkward case, and plain Python versions of the operators."""

from __future__ import annotations

import random
import re

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "th long, key string, size string, component string, target int, `start.stop` string, "
    "gone long, _metadata string, copy string, _copy int, id_ long, spans string, _spans int, task int, nth long, block long"
)
EMPTY_SCHEMA = SCHEMA
WHITE = r"[\x20\x09-\x0D]+"


def words(text: str | None) -> list[str]:
    return [w for w in re.split(WHITE, text or "") if w]


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) + str(rng.randrange(40)) for _ in range(n))


def documents(seed: int = 3) -> list[tuple]:
    """Prose, exact and near copies, shared passages, repeated lines, blanks, nulls, a long text, repeated rows."""
    rng = random.Random(seed)
    passage, line = prose(rng, 60), prose(rng, 9)
    texts: list[str | None] = [prose(rng, rng.randrange(1, 120)) for _ in range(20)]
    texts += [texts[3], texts[3] + "  ", texts[4].replace(" ", "\n", 2)]
    base = prose(rng, 150).split()
    for _ in range(6):
        near = list(base)
        near[rng.randrange(len(near))] = "changed"
        texts.append(" ".join(near))
    texts += [f"{prose(rng, 20)} {passage} {prose(rng, 5)}" for _ in range(4)]
    cut = line.split()
    edited = [" ".join(cut[:4] + cut[5:]), " ".join(cut[:4] + ["new"] + cut[4:]), " ".join(cut[:4] + ["new"] + cut[5:])]
    texts += [f"{prose(rng, 6)}\n{x}\n\n{prose(rng, 7)}" for x in [line, *edited, line]]
    texts += ["", None, " \t\n\x0b\x0c\r ", "a", "a b", "A b", "é中\U0001f600 x", prose(rng, 5000), "w " * 130]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(5, texts[5]), (7, "other text of the same id, long enough to matter here"), (None, texts[0]), (None, None)]
    rng.shuffle(rows)
    return [
        (i, t, "en", None if i == 2 else f"s{(i or 0) % 5}", len(t or ""), 1, "k", "z", "c", 2, "x",
         1, "m", "y", 3, 4, "s", 5, 6, 7, 8)
        for i, t in rows
    ]


def frame(spark, rows: list[tuple] | None = None):
    """Rows as a table; those with fewer fields than the schema have nulls in the others."""
    width = SCHEMA.count(",") + 1
    return spark.createDataFrame([(*r, *[None] * (width - len(r))) for r in (documents() if rows is None else rows)], SCHEMA)


def unique_ids(rows: list[tuple]) -> list[tuple]:
    seen, out = set(), []
    for r in rows:
        if r[0] is not None and r[0] not in seen:
            seen.add(r[0])
            out.append(r)
    return out


def find(parent: dict, x):
    while parent[x] != x:
        x = parent[x]
    return x


def classes(nodes, links) -> dict:
    parent = {n: n for n in nodes}
    for a, b in links:
        a, b = find(parent, a), find(parent, b)
        parent[max(a, b)] = min(a, b)
    return {n: find(parent, n) for n in nodes}
