"""Plain, slow versions of the operators' contracts, and small documents with every awkward case."""

import hashlib
import re

SF = "/root/testdata/sf0.001"
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def lowered(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def repeats(docs: list[tuple[int, str | None]], length: int) -> dict[int, tuple[int, int, str]]:
    words = {i: SPACE.findall(t or "") for i, t in docs}
    seen: dict[tuple, int] = {}
    for w in words.values():
        for k in range(len(w) - length + 1):
            seen[tuple(w[k : k + length])] = seen.get(tuple(w[k : k + length]), 0) + 1
    out = {}
    for i, w in words.items():
        gone = set()
        for k in range(len(w) - length + 1):
            if seen[tuple(w[k : k + length])] > 1:
                gone.update(range(k, k + length))
        out[i] = (len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def leaks(docs, items, window: int) -> dict[int, tuple[int, int, list[str]]]:
    cut = [(i, ALNUM.findall(lowered(t or ""))) for i, t in items]
    out = {}
    for d, text in docs:
        words = ALNUM.findall(lowered(text or ""))
        hit, named = set(), set()
        for i, w in cut:
            size = min(window, len(w))
            for k in range(len(w) - size + 1 if size else 0):
                for p in range(len(words) - size + 1):
                    if words[p : p + size] == w[k : k + size]:
                        hit.update(range(p, p + size))
                        if i is not None:
                            named.add(str(i))
        out[d] = (len(words), len(hit), sorted(named))
    return out
