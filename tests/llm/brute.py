"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import public_tokenizers
import xxhash

WS = " \t\n\x0b\x0c\r"


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


# ---- operator 1
def secrets(text: str | None) -> list[tuple[str, int, int]]:
    text = text or ""
    out = []
    for m in re.finditer(
        r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text
    ):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, "assign", m.end()))
    for m in re.finditer("AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 20:
            out.append((m.start(), 1, "access", m.end()))
    for m in re.finditer("[0-9a-f]+", text):
        if len(m[0]) >= 24:
            out.append((m.start(), 2, "hex", m.end()))
    return [(kind, s, e) for s, _, kind, e in sorted(out)]


# ---- operator 2
def paragraph_classes(docs, min_words=20, n=5, least=0.8):
    """{(doc_id, paragraph): (doc_id, paragraph) of the class's first} for classes of two or more."""
    keys, sets = [], []
    for d, t in docs:
        for i, line in enumerate((t or "").split("\n")):
            w = line.encode().lower().split()
            if len(w) >= min_words:
                keys.append((d, i))
                sets.append(frozenset(tuple(w[j : j + n]) for j in range(max(1, len(w) - n + 1))))
    root = list(range(len(keys)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both >= least * (len(a) + len(sets[j]) - both) - 1e-9:
                root[max(find(i), find(j))] = min(find(i), find(j))
    groups = defaultdict(list)
    for i, k in enumerate(keys):
        groups[find(i)].append(k)
    first = lambda g: min(g, key=lambda k: (k[0] is None, k[0] or 0, k[1]))
    return {k: first(g) for g in groups.values() if len(g) > 1 for k in g}


def passages(docs, window=50):
    """(doc_id, start, end, n_words, removed) of the runs of words in repeated windows."""
    words = [[(m.start(), m.end(), m[0].encode().lower()) for m in re.finditer(f"[^{WS}]+", t or "")] for _, t in docs]
    place = lambda r, i: (docs[r][0] is None, docs[r][0] or 0, i, docs[r][1])
    held = defaultdict(set)
    gram = lambda r, i: tuple(w for _, _, w in words[r][i : i + window])
    for r in range(len(docs)):
        for i in range(len(words[r]) - window + 1):
            held[gram(r, i)].add(place(r, i))
    out = []
    for r, (d, _) in enumerate(docs):
        state = [0] * len(words[r])
        for i in range(len(words[r]) - window + 1):
            places = held[gram(r, i)]
            if len(places) > 1:
                mine = 1 if min(places) == place(r, i) else 2
                state[i : i + window] = [max(x, mine) for x in state[i : i + window]]
        cuts = [i for i in range(len(state) + 1) if i in (0, len(state)) or state[i] != state[i - 1]]
        out += [
            (d, words[r][a][0], words[r][b - 1][1], b - a, state[a] == 2) for a, b in zip(cuts, cuts[1:], strict=False) if state[a]
        ]
    return out


# ---- operator 5
def line_key(line: str) -> str:
    return line.strip(WS).encode().lower().decode()


def line_dedup(docs, min_length=20, min_documents=3):
    """Per row (lines before, lines dropped, text after)."""
    order = lambda d: (d is not None, d or 0)
    held = defaultdict(set)
    for d, t in docs:
        for line in (t or "").split("\n"):
            if len(line_key(line)) >= min_length:
                held[line_key(line)].add(order(d))
    out = []
    for d, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(held[line_key(x)]) >= min_documents and max(held[line_key(x)]) != order(d))]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


# ---- operator 6
def word_ids(text: str | None) -> list[int]:
    from tokenizers import Tokenizer

    if not hasattr(word_ids, "tokenizer"):
        word_ids.tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
        word_ids.tokenizer.encode_special_tokens = True
    return [*word_ids.tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


# ---- operator 7
LIMITS = {5: 25, 6: 24, 7: 23, 8: 22, 9: 21, 10: 20}


def quality(text: str | None) -> dict:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)

    def covered(n):
        grams = Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
        out = set()
        for i in range(len(words) - n + 1):
            if grams[tuple(words[i : i + n])] > 1:
                out.update(range(i, i + n))
        return out

    seen, dup, dup_chars = set(), 0, 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            if line in seen:
                dup += 1
                dup_chars += len(line)
            seen.add(line)
    chars = sum(map(len, words))
    repeat = len(covered(5))
    failed = len(words) < 10 or 100 * repeat > 20 * len(words)
    kept = not failed and 100 * dup_chars <= 30 * len(text)
    for n, limit in LIMITS.items():
        kept = kept and 100 * sum(len(words[i]) for i in covered(n)) <= limit * chars
    return {
        "n_words": len(words), "word_chars": chars, "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": dup, "n_repeat_words": repeat, "base_failed": failed, "kept": kept,
    }


# ---- operator 8
def substring_dedup(texts, length=200):
    """Per text (bytes, removed, spans, sha of the rest)."""
    data = [(t or "").encode() for t in texts]
    counts = Counter(t[i : i + length] for t in data for i in range(len(t) - length + 1))
    out = []
    for t in data:
        gone = bytearray(len(t) + 1)
        for i in range(len(t) - length + 1):
            if counts[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(t), sum(gone), spans, sha(bytes(b for i, b in enumerate(t) if not gone[i]))))
    return out


# ---- operator 9
def fingerprint(text: str | None, n: int = 3) -> int:
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    grams = [b" ".join(words[i : i + n]) for i in range(max(len(words) - n + 1, 1))]
    ones = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g, 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(grams))


def simhash_components(docs, most=3):
    """Per row (fingerprint, smallest doc_id of its component, first row of it)."""
    prints = [fingerprint(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= most:
                root[max(find(i), find(j))] = min(find(i), find(j))
    members = defaultdict(list)
    for i, (d, _) in enumerate(docs):
        members[find(i)].append(d)
    least = {r: min((d for d in ds if d is not None), default=None) for r, ds in members.items()}
    return [(prints[i], least[find(i)], find(i)) for i in range(len(docs))]
