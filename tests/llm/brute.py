"""Plain statements of the contracts, for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BENCH = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def words(text):
    return WORD.findall(text or "")


def targets(rows):
    """source -> target, by resharing the excess until none is above."""
    size = Counter()
    for _, source, text in rows:
        size[source] += len(words(text))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, rest, left = {}, set(order), 1.5 * sum(size.values())
    while rest:
        total = sum(weight[s] for s in rest)
        above = [s for s in rest if left * weight[s] / total > 2 * size[s]]
        if not above:
            target.update({s: left * weight[s] / total for s in rest})
            break
        for s in above:
            target[s] = 2.0 * size[s]
        left -= sum(2 * size[s] for s in above)
        rest -= set(above)
    return size, target


def contaminated(docs, items):
    grams = defaultdict(set)
    for item, text in items:
        w = BENCH.findall((text or "").translate(UPPER))
        k = min(10, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            grams[tuple(w[i : i + k])].add(item)
    lengths = {len(g) for g in grams}
    out = []
    for doc_id, text in docs:
        w = BENCH.findall((text or "").translate(UPPER))
        hit, found = set(), set()
        for k in lengths:
            for i in range(len(w) - k + 1):
                if (got := grams.get(tuple(w[i : i + k]))) is not None:
                    hit.update(range(i, i + k))
                    found |= {str(x) for x in got if x is not None}
        out.append((doc_id, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def passages(docs, window=50):
    first = {}
    for doc_id, text in docs:
        w = words(text)
        for i in range(len(w) - window + 1):
            g = tuple(w[i : i + window])
            o = doc_id if doc_id is not None else 1 << 63
            first[g] = min(first.get(g, o), o)
    out = []
    for doc_id, text in docs:
        w = words(text)
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < (doc_id if doc_id is not None else 1 << 63):
                gone.update(range(i, i + window))
        out.append((doc_id, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def secrets(docs):
    kinds = {"assign": (re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|"""
                                   r"""[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 12),
             "access": (re.compile("AKIA[A-Z0-9]+"), 0, 18), "hex": (re.compile("[0-9a-f]+"), 0, 16)}
    out = []
    for doc_id, text in docs:
        spans, n = [], []
        for i, (kind, (pattern, group, least)) in enumerate(kinds.items()):
            got = [(m.start(), i, m.end(), kind) for m in pattern.finditer(text or "") if len(m[group]) >= least]
            n.append(len(got))
            spans += got
        out.append((doc_id, *n, sha(",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(spans)))))
    return out


def near(docs, width=4):
    sets = []
    for doc_id, text in docs:
        w = words((text or "").translate(UPPER))
        k = min(width, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if k else set())
    n = len(docs)
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= 80 * (len(a) + len(b) - both):
                    root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        r = find(i)
        ids = [x for x in (least.get(r), doc_id) if x is not None]
        least[r] = min(ids) if ids else None
    return [(d, len(sets[i]), least[find(i)], d == least[find(i)]) for i, (d, _) in enumerate(docs)]


def quality(docs):
    out = []
    for doc_id, text in docs:
        text = text or ""
        w = words(text)
        seen, dup = set(), 0
        for line in text.split("\n"):
            if words(line):
                dup += line in seen
                seen.add(line)
        grams = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        rep = {j for i in range(len(w) - 7) if grams[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
        out.append((doc_id, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(rep),
                    len(w) < 20 or 100 * len(rep) > 30 * len(w)))
    return out


RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def urls(pages):
    out = []
    for page_id, url in pages:
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            host = re.match(r"[^/?#]*", rest)[0]
            path = re.match(r"[^?#]*", rest[len(host) :])[0]
            host = host.translate(UPPER)
        fits = [(len(h + p), h + p, k) for k, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, None, None))
        out.append((page_id, host, path, best[1], best[2]))
    return out


def unigram(docs, held):
    import math

    count = Counter()
    for (doc_id, text), h in zip(docs, held):
        if not h:
            count.update([*words((text or "").translate(UPPER)), None])
    n, v = sum(count.values()), len(count)
    out = []
    for (doc_id, text), h in zip(docs, held):
        tokens = [*words((text or "").translate(UPPER)), None]
        out.append((doc_id, h, len(tokens), sum(count[t] > 0 for t in tokens), n,
                    sum(math.log10((count[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens)))
    return out


def _digest(*parts):
    return sha("".join(parts))


def _field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def _leaf(doc_id, text, lang, source, n_chars):
    return _digest(*map(_field, (doc_id, source, lang, n_chars, text)))


def _tree(nodes):
    """Root, and per leaf its (left siblings, right siblings) from the leaf up."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, i in zip(paths, range(len(paths))):
            low = at[i] // 16 * 16
            path.append((nodes[low : at[i]], nodes[at[i] + 1 : low + 16]))
            at[i] //= 16
        nodes = [_digest(*nodes[low : low + 16]) for low in range(0, len(nodes), 16)]
    return nodes[0], paths


def manifest(rows):
    """op13 rows of (doc_id, text, lang, source, n_chars)."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[3]].append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    subs, inner, leaves = [], [], []
    for name in names:
        leaves.append(sorted(((_leaf(*r), r) for r in groups[name]), key=lambda x: (x[1][0] is not None, x[1][0] or 0, x[0])))
        top, paths = _tree([leaf for leaf, _ in leaves[-1]])
        subs.append(top)
        inner.append(paths)
    if not names:
        return []
    root, tops = _tree(subs)
    out = []
    for sub, top, items, paths in zip(subs, tops, leaves, inner):
        for (leaf, r), path in zip(items, paths):
            got = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[1] is not None:
                got = _leaf(r[0], r[1].translate(UPPER), *r[2:])
            for left, right in path + top:
                got = _digest(*left, got, *right)
            proof = _digest(*[h for left, right in path + top for h in left + right])
            out.append((r[0], leaf, sub, root, proof, got, got == root))
    return out


def _slots(text):
    """Hashed 1- to 3-grams of the letters of a text, gaps one character wide."""
    low = [c if "a" <= c <= "z" or (ord(c) >= 0xAA and c.isalpha()) else " " for c in (text or "").lower()]
    if not any(c != " " for c in low):
        return None
    chars = [ord(c) for c in re.sub(" +", " ", " " + "".join(low) + " ")]
    m, (k0, k1, k2) = 1 << 32, (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)
    out = Counter()
    for i, c in enumerate(chars):
        h = c * k0 % m
        out[((h ^ (h >> 15)) * k2 % m) >> 19] += 1
        for j, k in ((i + 1, k2), (i + 2, k0)):
            if j < len(chars):
                h = (h * k1 + chars[j] * k) % m
                out[((h ^ (h >> 15)) * k2 % m) >> 19] += 1
    return out


def _unit(v):
    size = math.sqrt(sum(x * x for x in v.values())) or 1.0
    return {s: x / size for s, x in v.items()}


def _dot(a, b):
    return sum(x * b.get(s, 0.0) for s, x in a.items())


def _mean(vectors):
    total = Counter()
    for v in vectors:
        for s, x in v.items():
            total[s] += x
    return _unit(total)


def languages(docs, held, centroids=4, turns=8, reject=0.5):
    """(doc_id, lang, cosine, floor) of every (doc_id, text, lang); ``held(doc_id)``
    teaches nothing. Every text is taken into the sample once an id."""
    train = [(d, t, lang) for d, t, lang in docs if lang is not None and not held(d)]
    grams = [(g, lang) for d, t, lang in train if (g := _slots(t)) is not None]
    df = Counter(s for g, _ in grams for s in g)
    idf = lambda s: math.log((1 + len(grams)) / (1 + df[s])) + 1
    vector = lambda g: _unit({s: math.log1p(n) * idf(s) for s, n in g.items()})
    centres, floor = [], {}
    for lang in sorted({lang for _, lang in grams}):
        texts = {(d, t) for d, t, x in train if x == lang}
        mine = [vector(g) for _, t in sorted(texts, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")) if (g := _slots(t)) is not None]
        c = [_mean(mine)]
        while len(c) < min(centroids, len(mine)):
            c.append(min(mine, key=lambda v: max(_dot(v, y) for y in c)))
        for _ in range(turns):
            near = [max(range(len(c)), key=lambda j: _dot(v, c[j])) for v in mine]
            c = [_mean([v for v, n in zip(mine, near) if n == j]) if j in near else c[j] for j in range(len(c))]
        floor[lang] = reject * min(max(_dot(v, y) for y in c) for v in mine)
        centres += [(lang, y) for y in c]
    out = []
    for d, t, _ in docs:
        g = _slots(t)
        if g is None or not centres:
            out.append((d, "und", 0.0, None))
        else:
            v = vector(g)
            score, lang = max(((_dot(v, y), lang) for lang, y in centres), key=lambda x: x[0])
            out.append((d, lang, min(1.0, max(0.0, score)), floor[lang]))
    return out
