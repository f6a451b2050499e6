"""Plain forms of what the operators compute, for small tables."""

import re
from collections import defaultdict
from hashlib import sha256
from zlib import crc32

SPACE = r"[^\x20\x09-\x0D]+"


def repeated_bytes(rows, width):
    """doc_id -> (bytes, removed, spans, digest); rows in order of their ids."""
    seen, out = set(), {}
    for doc, text in sorted(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - width + 1):
            window = data[i : i + width]
            if window in seen:
                gone[i : i + width] = b"\1" * width
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out[doc] = (len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha256(kept).hexdigest())
    return out


def repeated_words(rows, width):
    seen, out = set(), {}
    for doc, text in sorted(rows):
        words = re.findall(SPACE, text or "")
        gone = [False] * len(words)
        windows = [tuple(words[i : i + width]) for i in range(len(words) - width + 1)]
        for i, window in enumerate(windows):
            if window in seen:
                gone[i : i + width] = [True] * width
        seen.update(windows)
        kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out[doc] = (len(words), sum(gone), sha256(kept.encode()).hexdigest())
    return out


def shingle_set(text, width=5):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(SPACE, lower)
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def near_components(rows, percent=85):
    """doc_id -> (set size, least id that can be reached)."""
    sets = {doc: shingle_set(text) for doc, text in rows}
    near = defaultdict(set)
    for a, x in sets.items():
        for b, y in sets.items():
            both = len(x & y)
            if a != b and x and y and 100 * both >= percent * len(x | y):
                near[a].add(b)
    out = {}
    for doc in sets:
        reached, todo = {doc}, [doc]
        while todo:
            new = near[todo.pop()] - reached
            reached |= new
            todo += new
        out[doc] = (len(sets[doc]), min(reached))
    return out


def base_secrets(text):
    key = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in "password|passwd|secret|token|api_?key")
    found = [
        (m.start(), 0, "assign", m.end())
        for m in re.finditer(rf"""({key})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text)
        if len(m[2]) >= 6
    ]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [f"{kind}:{a}:{b}" for a, _, kind, b in sorted(found)]


def merkle(rows):
    """One tuple per (doc_id, source, lang, n_chars, text) row, as the manifest query has its columns."""

    def digest(*parts):
        return sha256("".join(parts).encode()).hexdigest()

    def leaf(row):
        return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    def climb(level):
        """The digest at the top, and for each item its (left siblings, right siblings) per level."""
        paths, members = [[] for _ in level], [[i] for i in range(len(level))]
        while len(level) > 1:
            above, joined = [], []
            for at in range(0, len(level), 3):
                run = level[at : at + 3]
                for k in range(len(run)):
                    for i in members[at + k]:
                        paths[i].append((run[:k], run[k + 1 :]))
                above.append(digest(*run))
                joined.append([i for m in members[at : at + 3] for i in m])
            level, members = above, joined
        return level[0], paths

    by_source = defaultdict(list)
    for row in rows:
        by_source[row[1]].append(row)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in sources:
        held = sorted(by_source[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[source] = (held, *climb([leaf(r) for r in held]))
    root, tops = climb([trees[s][1] for s in sources])
    out = []
    for source, top in zip(sources, tops, strict=True):
        held, subroot, paths = trees[source]
        for row, path in zip(held, paths, strict=True):
            tampered = row
            if row[0] is not None and row[4] is not None and crc32(str(row[0]).encode()) % 2 == 0:
                tampered = (*row[:4], row[4].replace("\n", ""))
            folded, siblings = leaf(tampered), []
            for left, right in path + top:
                folded = digest(*left, folded, *right)
                siblings += left + right
            out.append((row[0], leaf(row), subroot, root, digest(*siblings), folded, folded == root))
    return out


def kept_lines(rows, least_length=20, least_documents=3):
    """(doc_id, lines, dropped, digest) per row."""
    space = " \t\n\x0b\x0c\r"

    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(space))

    holders = defaultdict(list)
    for doc, text in rows:
        for k in {key(line) for line in (text or "").split("\n")}:
            if len(k) >= least_length:
                holders[k].append(doc)
    keeper = {
        k: max((d for d in docs if d is not None), default=None) for k, docs in holders.items() if len(docs) >= least_documents
    }
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [line for line in lines if keeper.get(key(line), doc) == doc]
        out.append((doc, len(lines), len(lines) - len(kept), sha256("\n".join(kept).encode()).hexdigest()))
    return out


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def word_variants(rows, every=31):
    """(word, form, root, n, n_near, form_n) per word."""
    counts = defaultdict(int)
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if doc is None else doc}:{word}".encode())
            if h % every == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            counts[word] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    forms, out = {}, []
    for word, n in counts.items():
        near = [v for v in counts if one_edit(word, v)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= 10 * n:
            forms[word] = best
        out.append((word, forms.get(word), n, len(near)))
    rooted = []
    for word, form, n, n_near in out:
        root = word
        while root in forms:
            root = forms[root]
        rooted.append((word, form, root, n, n_near, counts.get(form)))
    return rooted
