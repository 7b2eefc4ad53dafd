"""Brute-force versions of the operators, for small inputs."""

import hashlib
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text)


def suffix_dedup(rows, match=50):
    first = {}
    texts = [(d, (t or "").encode()) for d, t in rows]
    for d, b in texts:
        for i in range(len(b) - match + 1):
            w = b[i: i + match]
            if d < first.get(w, d + 1):
                first[w] = d
    out = []
    for d, b in texts:
        dead = bytearray(len(b))
        for i in range(len(b) - match + 1):
            if first[b[i: i + match]] < d:
                dead[i: i + match] = b"\1" * match
        kept = bytes(c for c, x in zip(b, dead) if not x)
        spans = len(re.findall(b"\1+", bytes(dead)))
        out.append((d, len(b), sum(dead), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def shingles(text, k=5):
    w = WORD.findall(lower(text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i: i + k]) for i in range(max(1, len(w) - k + 1)))


def components(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def near_dups(rows):
    rows = sorted(rows)
    sets = [shingles(t) for _, t in rows]
    holders, links = {}, set()
    for i, s in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(i)
    seen = set()
    for held in holders.values():
        for x, a in enumerate(held):
            for b in held[x + 1:]:
                seen.add((a, b))
    for a, b in seen:
        both = len(sets[a] & sets[b])
        if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            links.add((a, b))
    comp = components(len(rows), links)
    return [(d, len(s), rows[c][0], rows[c][0] == d) for (d, _), s, c in zip(rows, sets, comp)]


def rule_counts(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    held = {}
    for i in range(len(w) - 4):
        held.setdefault(tuple(w[i: i + 5]), []).append(i)
    again = {j for at in held.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(again)


def base_pii(text):
    text = text or ""
    out = []
    for kind, pattern in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
                          ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card":
                twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
                if not 16 <= len(digits) <= 19 or sum(x // 10 + x % 10 for x in twice) % 10:
                    continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def merkle(rows, fanout=8):
    """(doc_id, leaf, subroot, root, proof hash, folded root, verified) of rows (doc_id, text, lang, source, n_chars)."""
    def h(*parts):
        return hashlib.sha256("".join(parts).encode()).hexdigest()

    def leaf(r, text):
        return h(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in (r[0], r[3], r[2], r[4], text)])

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([h(*levels[-1][i: i + fanout]) for i in range(0, len(levels[-1]), fanout)])
        return levels

    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    groups = {g: sorted((r for r in rows if r[2] == g), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1]))) for g in langs}
    trees = {g: tree([leaf(r, r[1]) for r in groups[g]]) for g in langs}
    top = tree([trees[g][-1][0] for g in langs])
    out = []
    for k, g in enumerate(langs):
        for i, r in enumerate(groups[g]):
            own = leaf(r, r[1])
            node = own
            if r[0] is not None and r[1] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                node = leaf(r, lower(r[1]))
            proof = ""
            for levels, p in ((trees[g], i), (top, k)):
                for level in levels[:-1]:
                    a = p // fanout * fanout
                    left, right = "".join(level[a:p]), "".join(level[p + 1: a + fanout])
                    proof, node, p = proof + left + right, h(left, node, right), p // fanout
            out.append((r[0], own, trees[g][-1][0], top[-1][0], h(proof), node, node == top[-1][0]))
    return sorted(out, key=str)


def windows_dedup(rows, k):
    """(doc_id, words, words removed, kept text) where windows of k words that also start earlier are removed."""
    texts, first = [(d, WORD.findall(t or "")) for d, t in rows], {}
    for d, w in texts:
        for i in range(len(w) - k + 1 if d is not None else 0):
            seen = first.setdefault(tuple(w[i: i + k]), (d, i))
            first[tuple(w[i: i + k])] = min(seen, (d, i))
    out = []
    for d, w in texts:
        gone = set()
        for i in range(len(w) - k + 1 if d is not None else 0):
            if first[tuple(w[i: i + k])] < (d, i):
                gone.update(range(i, i + k))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def turn_edits(initials, faults):
    """Cheapest, then ASCII-least edits, by relaxing (cost, edits) of every state row by row."""
    after = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    speak = {0: 2, 1: 2, 2: 3, 3: 2}

    def spoken(at):
        for _ in range(3):
            for s, (c, e) in list(at.items()):
                at[speak[s]] = min(at.get(speak[s], (10**9, "")), (c + 2, e + "I"))
        return at

    at = {0: (0, "")}
    for x, f in zip(initials, faults):
        new = {}
        for s, (c, e) in spoken(at).items():
            moves = [(s, 3, "D")]
            if f not in "bd":
                moves += [(speak[s], 2 + (f == "t"), "R")] + ([(after[s, x], f == "t", "K")] if (s, x) in after else [])
            for to, cost, edit in moves:
                new[to] = min(new.get(to, (10**9, "")), (c + cost, e + edit))
        at = new
    return min(v for s, v in spoken(at).items() if s in (0, 3))
