"""Plain versions of the operators, for small tables."""

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, width):
    words = WORD.findall(low(text))
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def components(rows, width, part, of):
    """Sorted (doc_id, set size, smallest doc_id of the component) as strings."""
    sets = [shingles(text, width) for _, text in rows]
    holders = {}
    for i, s in enumerate(sets):
        for gram in s:
            holders.setdefault(gram, []).append(i)
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i, s in enumerate(sets):
        for j, both in Counter(j for gram in s for j in holders[gram] if j < i).items():
            if of * both >= part * (len(s) + len(sets[j]) - both):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted((str(d), len(sets[i]), str(least.get(find(i)))) for i, (d, _) in enumerate(rows))


def repeats(rows, width):
    """Sorted (doc_id, removed bytes, runs, sha256 of the rest) as strings."""
    texts = [(text or "").encode() for _, text in rows]
    places = {}
    for i, text in enumerate(texts):
        for at in range(len(text) - width + 1):
            places.setdefault(text[at : at + width], []).append((i, at))
    covered = [bytearray(len(t)) for t in texts]
    for found in places.values():
        if len(found) > 1:
            for i, at in found:
                covered[i][at : at + width] = b"\1" * width
    out = []
    for (doc_id, _), text, marks in zip(rows, texts, covered, strict=True):
        runs = sum(1 for i, m in enumerate(marks) if m and (i == 0 or not marks[i - 1]))
        rest = bytes(b for b, m in zip(text, marks, strict=True) if not m)
        out.append((str(doc_id), sum(marks), runs, hashlib.sha256(rest).hexdigest()))
    return sorted(out)


def statistics(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = WORD.findall(text)
    starts = {}
    for i in range(len(words) - 2):
        starts.setdefault(tuple(words[i : i + 3]), []).append(i)
    repeated = {i + k for at in starts.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(repeated),
    )


def hashed(text):
    return hashlib.sha256(text.encode()).hexdigest()


def merkle_rows(rows, changed):
    """Sorted (doc_id, leaf, subroot, root, proof, folded root) of (doc_id, source, lang, n_chars, text) rows."""

    def leaf_of(row):
        return hashed("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    def fold(level):
        levels = [level]
        while len(levels[-1]) > 1:
            below = levels[-1]
            levels.append([hashed("".join(below[i : i + 2])) for i in range(0, len(below), 2)])
        return levels

    def sides(levels, at):
        return [(below[at >> i ^ 1] if at >> i ^ 1 < len(below) else "", at >> i & 1) for i, below in enumerate(levels[:-1])]

    languages = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    placed = {
        name: sorted(((r[0] is not None, r[0] or 0, leaf_of(r), r) for r in rows if r[2] == name), key=lambda x: x[:3])
        for name in languages
    }
    trees = {name: fold([p[2] for p in placed[name]]) for name in languages}
    top = fold([trees[name][-1][0] for name in languages])
    out = []
    for i, name in enumerate(languages):
        for at, (_, _, leaf, row) in enumerate(placed[name]):
            path = sides(trees[name], at) + sides(top, i)
            node = leaf_of((*row[:3], None if row[3] is None else row[3] + 1, row[4])) if changed(row[0]) else leaf
            for other, right in path:
                node = hashed(other + node if right else node + other)
            out.append((str(row[0]), leaf, trees[name][-1][0], top[-1][0], hashed("".join(p[0] for p in path)), node))
    return sorted(out)


def trie_rows(sequences):
    """Sorted (conv_id, depth, parent, members, children, leaves, saved, ends digest) of {id: [(role, text), ...]}."""
    members, ends = {}, {}
    for conv_id, turns in sequences.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv_id)
        ends.setdefault(tuple(turns), []).append(conv_id)
    children = Counter(node[:-1] for node in members if node)
    leaves, saved = Counter(), Counter()
    for node, ids in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(ids) - 1) * len(node[-1][1]) if node else 0
    return sorted(
        (
            min(ids), len(node), str(min(members[node[:-1]]) if node else None), len(ids), children[node],
            leaves[node], saved[node], hashed(",".join(map(str, sorted(ends.get(node, []))))),
        )
        for node, ids in members.items()
    )
