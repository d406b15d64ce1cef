"""Plain Python forms of the operators' results, for small tables."""

import hashlib
from collections import Counter, defaultdict

import xxhash

SPACES = " \t\n\x0b\x0c\r"


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def words(text):
    return (text or "").encode().split()


def equal_groups(rows):
    """(doc_id, text) -> doc_id, keep_id, group_size, kept, sha; one result per row."""
    groups = defaultdict(list)
    for i, (doc_id, text) in enumerate(rows):
        norm = "".join(c for c in text or "" if c not in SPACES)
        groups[norm].append((-len(text or ""), doc_id is None, doc_id or 0, i))
    found = []
    for norm, members in groups.items():
        best = min(members)
        for m in members:
            keep = rows[best[3]][0]
            found.append((rows[m[3]][0], keep, len(members), m[3] == best[3], sha(norm)))
    return found


def dedup_lines(rows):
    def key(line):
        found = line.strip(SPACES)
        found = "".join(c.lower() if "A" <= c <= "Z" else c for c in found)
        return found if len(found) >= 20 else None

    holders = defaultdict(list)
    for doc_id, text in rows:
        for k in {key(line) for line in (text or "").split("\n")} - {None}:
            holders[k].append(doc_id)
    last = {k: max((d for d in ids if d is not None), default=None) for k, ids in holders.items()}
    found = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        left = []
        for line in lines:
            k = key(line)
            if k is None or len(holders[k]) < 3 or doc_id == last[k]:
                left.append(line)
        found.append((doc_id, len(lines), len(lines) - len(left), sha("\n".join(left))))
    return found


def dedup_passages(rows, passage):
    """(doc_id, text) -> doc_id, n_words, n_dropped and the words that are left."""
    split = [words(text) for _, text in rows]
    at = [[tuple(x.lower() for x in w[i : i + passage]) for i in range(len(w) - passage + 1)] for w in split]
    stays = {}
    for i in sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0)):
        for p in at[i]:
            stays.setdefault(p, i)
    found = []
    for i, (doc_id, _) in enumerate(rows):
        gone = {k + j for k, p in enumerate(at[i]) if stays[p] != i for j in range(passage)}
        left = b" ".join(w for k, w in enumerate(split[i]) if k not in gone)
        found.append((doc_id, len(split[i]), len(gone), left))
    return found


def simhash(text, shingle=4):
    w = [x.lower() for x in words(text)]
    if not w:
        return 0
    parts = [b" ".join(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(rows, distance=4):
    prints = [simhash(text) for _, text in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                group[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return [(rows[i][0], f"{prints[i]:016x}", least.get(root(i))) for i in range(len(rows))]


def quality(text):
    text = text or ""
    w = words(text)
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    dup = len(lines) - len(set(lines))
    chars = sum(len(x.decode()) for x in w)
    symbols = sum(c in "#*$%&|<>" for c in text)
    n, rep = len(w), len(covered)
    failed = n < 10 or 100 * rep > 20 * n
    bad = failed or 100 * symbols > 10 * n or 100 * dup > 30 * len(lines)
    return n, chars, symbols, dup, rep, failed, not (bad or chars < 2 * n or chars > 20 * n)


def targets(sizes, weights=(1, 2, 3)):
    """source -> words, to source -> target."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    open_, given, total = set(order), {}, sum(sizes.values())
    while open_:
        level = (total - sum(given.values())) / sum(weight[s] for s in open_)
        full = {s for s in open_ if 3 * sizes[s] < level * weight[s]}
        if not full:
            return given | {s: level * weight[s] for s in open_}
        given |= {s: 3 * sizes[s] for s in full}
        open_ -= full
    return given
