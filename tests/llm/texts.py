"""Small documents for the tests: vocabulary, junk, copies and edge cases."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score string, kept string, n long, "
          "bucket string, chunk string, fp string, line string, tokens string, component_id string, h1 string, quality string")
N_EXTRA = 14


def row(doc_id, text):
    """A row of ``SCHEMA``: the other columns only clash with names that operators use inside."""
    return (doc_id, text, "en", "s", None, "x", "y", 5, "b", "c", "f", "l", "t", "i", "h", "q")


def frame(spark, docs):
    return spark.createDataFrame([row(i, t) for i, t in docs], SCHEMA)


def words(rng: random.Random, n: int, vocabulary: int = 4000) -> list[str]:
    return [f"w{int(rng.paretovariate(0.7)) % vocabulary}" if rng.random() < 0.3 else f"v{rng.randrange(vocabulary)}" for _ in range(n)]


def prose(rng: random.Random, n: int) -> str:
    out = words(rng, n)
    return "".join(w + ("\n" if rng.random() < 0.08 else " ") for w in out).strip()


#: NULL, empty, blank, one word, other blanks, not ASCII, repeats, upper case.
EDGES = [None, "", " \t\n ", "one", "a b c d", "a b c d e", "A b 　 c\x0bd", "Été éTÉ ß 😀 x y z",
         "und " * 60, "A B C D", "#*$%&|<> !! ##\n#*$%&|<>\n\n#*$%&|<>"]


def corpus(seed: int = 5, n: int = 60) -> list[tuple[int | None, str | None]]:
    """Random texts with exact and near copies, a passage that a third shares, edge cases, a repeated row and a NULL id."""
    rng = random.Random(seed)
    base = [prose(rng, rng.randrange(30, 160)) for _ in range(n)]
    passage = " ".join(words(rng, 40))
    docs: list[tuple[int | None, str | None]] = []
    for i, t in enumerate(base):
        docs.append((i, t + ("\n" + passage if i % 3 == 0 else "")))
    at = n
    for k in range(0, n, 7):
        docs.append((at, docs[k][1]))
        w = docs[k][1].split(" ")
        w[len(w) // 2] = "changed"
        docs.append((at + 1, " ".join(w)))
        docs.append((at + 2, docs[k][1].upper()))
        at += 3
    docs += [(at + k, t) for k, t in enumerate(EDGES)]
    docs.append(docs[3])
    docs.append((None, base[1]))
    docs.append((at + 50, " ".join(words(rng, 6000))))
    rng.shuffle(docs)
    return docs


def unique_ids(docs):
    """The same documents with one row for each id, none NULL."""
    out = {}
    for i, t in docs:
        if i is not None:
            out.setdefault(i, t)
    return sorted(out.items())
