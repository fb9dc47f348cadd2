"""Small tables of awkward documents, and plain re-statements of what the operators must find."""

from __future__ import annotations

import random
import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Names the operators use inside, as columns of the table
EXTRA = "doc_id long, text string, uid string, key string, n long, u string, d string, score string, `count` long"


def prose(rng: random.Random, words: int, stock: int = 400) -> str:
    return " ".join(f"w{rng.randrange(stock)}" for _ in range(words))


def balanced(k: int, a: str = "a", b: str = "b") -> str:
    """The Thue-Morse string of length 2**k."""
    return "".join((a, b)[i.bit_count() % 2] for i in range(1 << k))


def awkward(seed: int = 1) -> list[tuple]:
    """Nulls, empty and one-word texts, copies, near copies, passages, long and periodic texts."""
    rng = random.Random(seed)
    base = [prose(rng, rng.randrange(60, 200)) for _ in range(12)]
    passage, other = prose(rng, 90), prose(rng, 70, 50)
    texts: list[str | None] = [None, "", " \n\t ", "one", "One", "é à ü", *base]
    for text in base[:4]:
        words = text.split(" ")
        for _ in range(3):
            at = rng.randrange(len(words))
            texts.append(" ".join([*words[:at], "edited", *words[at + 1 :]]))
    texts += [base[0], base[0].upper(), base[1] + " ", f"{prose(rng, 20)} {passage} {prose(rng, 30)}"]
    texts += [f"{prose(rng, 25)} {passage} tail", passage, f"x {other}\n{other} {passage[40:]}"]
    texts += ["ab " * 700, "a" * 1500, "\n".join(["same line here"] * 40), "ß€😀" * 300, "ß€😀" * 301 + " end"]
    texts += [prose(rng, 9000, 3000), "   ".join(["tie"] * 60)]
    # Words and lines that polynomial hashes modulo powers of two do not tell apart
    texts += ["\n".join(balanced(k).translate(str.maketrans("ab", pair)) for pair in ("ab", "ba", "ab")) for k in (10, 11)]
    texts += [f"{balanced(10, a, b)} " * 50 + tail for a, b, tail in (("a", "b", "x"), ("b", "a", "y"))]
    texts += [" ".join(balanced(11, a, b)) + f" {tail}" for a, b, tail in (("k", "l", "x"), ("l", "k", "y"))]
    ids = list(range(100, 100 + len(texts)))
    rng.shuffle(ids)
    return [(i, t) for i, t in zip(ids, texts)]


def with_extra(rows: list[tuple]) -> list[tuple]:
    return [(i, t, "x", "x", 1, None, "x", "x", 2) for i, t in rows]


def shingles(text: str | None, width: int) -> frozenset:
    words = WORDS.findall((text or "").translate(LOWER))
    if len(words) < width:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def components(rows: list[tuple], width: int, percent: int) -> dict[int, int]:
    sets = {i: shingles(t, width) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}
