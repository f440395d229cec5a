"""Plain versions of the operators, a row at a time, to compare with."""

import hashlib
import html
import math
import re
import zlib
from itertools import combinations

import numpy as np
import regex

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = _WORD.findall((text or "").translate(_UPPER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def near_duplicates(rows):
    """rows (doc_id, text) to {doc_id: (n_shingles, component_id)}; every pair is compared."""
    sets = {i: shingles(t) for i, t in rows if i is not None}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    pairs = {p for h in holders.values() for p in combinations(sorted(h), 2)}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= 75 * len(sets[a] | sets[b]):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def tokens(tokenizer, text, end_id):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, end_id]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def edited(rows):
    """rows (doc_id, text), distinct ids, to {doc_id: edited text}."""
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for k, (i, text) in enumerate(order):
        text = text or ""
        half = len(text) // 2
        following = order[(k + 1) % len(order)][1] or ""
        out[i] = text[: len(text) - half] + following[:half]
    return out


_SCRIPTS = "".join(rf"\p{{{s}}}" for s in ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar"))
_UNITS = regex.compile(rf"[{_SCRIPTS}]|[^\s{_SCRIPTS}]{{1,24}}")


def order_minhash(text, kmer=3, bins=64, least=2):
    """Bins to tuples of (k-mer, occurrence) in text order, with an own hash."""
    words = _UNITS.findall(text)
    seen, elements = {}, []
    for i in range(max(len(words) - kmer, 0) + 1):
        key = tuple(words[i : i + kmer])
        seen[key] = seen.get(key, -1) + 1
        digest = hashlib.md5(repr((key, seen[key])).encode()).digest()
        elements.append((digest[0] % bins, digest, i))
    out = {}
    for b in range(bins):
        chosen = sorted(e for e in elements if e[0] == b)[:least]
        if chosen:
            out[b] = tuple(d for _, d, _ in sorted(chosen, key=lambda e: e[2]))
    return out


def likeness(one, other):
    either = one.keys() | other.keys()
    return sum(one.get(b) == other.get(b) for b in either) / len(either)


_PATTERNS = (
    ("assign", re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
        r"""([A-Za-z0-9+/_.=-]+)""", re.I | re.A)),
    ("access", re.compile(r"AKIA[A-Z0-9]+")),
    ("hex", re.compile(r"[0-9a-f]+")),
)


def base_spans(text):
    found = []
    for order, (kind, pattern) in enumerate(_PATTERNS):
        for m in pattern.finditer(text or ""):
            size = len(m[2]) if kind == "assign" else len(m[0])
            if size >= {"assign": 6, "access": 20, "hex": 24}[kind]:
                found.append((m.start(), order, kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def article_text(page):
    """The text of the article element of the test pages."""
    inner = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S)
    if not inner:
        return ""
    blocks = re.split(r"<(?:/?(?:h1|p)|br)>", re.sub(r"</?b>", "", inner[1]))
    cleaned = (" ".join(html.unescape(b).split()) for b in blocks)
    return " ".join(b for b in cleaned if b)


def top_k(vectors, queries, k):
    """{query_id: [(vec_id, score)]} of dicts of lists of integers."""
    out = {}
    for q, v in queries.items():
        scores = [
            (i, sum(a * b for a, b in zip(v, w, strict=True))) for i, w in vectors.items() if i != q
        ]
        out[q] = sorted(scores, key=lambda s: (-s[1], s[0]))[:k]
    return out


def backoff(rows, trained, order, prior):
    """rows (key, text), the keys learned from, to {key: (n_tokens, n_known, base, score)}, N."""
    texts = {k: ["<s>"] + _WORD.findall((t or "").translate(_UPPER)) + ["</s>"] for k, t in rows}
    counts = {}
    for k, words in texts.items():
        if k in trained:
            for n in range(1, order + 1):
                for i in range(len(words) - n + 1):
                    gram = tuple(words[i : i + n])
                    counts[gram] = counts.get(gram, 0) + 1
    single = {g: c for g, c in counts.items() if len(g) == 1 and g != ("<s>",)}
    total, kinds = sum(single.values()), len(single)

    def chance(context, word):
        if not context:
            return (single.get((word,), 0) + 0.1) / (total + 0.1 * (kinds + 1))
        seen, before = counts.get((*context, word), 0), counts.get(context, 0)
        return (seen + prior * chance(context[1:], word)) / (before + prior)

    out = {}
    for k, words in texts.items():
        base = score = known = 0
        for i in range(1, len(words)):
            base += math.log10(chance((), words[i]))
            score += math.log10(chance(tuple(words[max(0, i - order + 1) : i]), words[i]))
            known += (words[i],) in single
        out[k] = (len(words) - 1, known, base, score)
    return out, total


def importance(rows, target, order=1, buckets=10_000, percent=10, seed="2024", least=20):
    """rows (doc_id, text) to a list of (doc_id, n_features, weight, score, rank)."""
    plain = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def features(text):
        words = plain.findall((text or "").translate(_UPPER))
        grams = [" ".join(words[i : i + n]) for n in range(1, order + 1)
                 for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(g.encode()) % buckets for g in grams]

    own = [(i, *features(t)) for i, t in rows]
    there = [b for t in target for b in features(t)[1]]
    here = [b for _, _, f in own for b in f]
    s, t = np.bincount(here, minlength=buckets).tolist(), np.bincount(there, minlength=buckets).tolist()
    gain = [
        math.floor(1000 * math.log((b + 1) * (len(here) + buckets) / ((a + 1) * (len(there) + buckets))))
        for a, b in zip(s, t, strict=True)
    ]
    scored = []
    for i, words, found in own:
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        digest = hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).hexdigest()
        noise = -1000 * math.log(-math.log((int(digest[:8], 16) + 0.5) / 4294967296))
        scored.append((i, len(found), weight, weight + math.floor(noise), words >= least))
    order_of = sorted((r for r in scored if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[2]))
    best = percent * len(order_of) // 100
    return [(*r[:4], k if k <= best else None) for k, r in enumerate(order_of, 1)] + [
        (*r[:4], None) for r in scored if not r[4]
    ]


def _hash(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _tree(digests, fan):
    """The root, and for each leaf the siblings and its place in the run, level by level."""
    paths, at, level = [[] for _ in digests], list(range(len(digests))), digests
    while len(level) > 1:
        runs = [level[i : i + fan] for i in range(0, len(level), fan)]
        for k, path in enumerate(paths):
            run, place = runs[at[k] // fan], at[k] % fan
            path.append((run[:place], run[place + 1 :]))
            at[k] //= fan
        level = [_hash("".join(r)) for r in runs]
    return level[0], paths


def manifest(rows, fan):
    """rows (key, tree, leaf digest) to the root and (key, leaf, subroot, path) of each row."""
    trees = {}
    for key, tree, leaf in rows:
        trees.setdefault(tree, []).append((key, leaf))
    names = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    tops, out = {}, []
    for name in names:
        trees[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        tops[name] = _tree([leaf for _, leaf in trees[name]], fan)
    root, crown = _tree([tops[n][0] for n in names], fan)
    for name, above in zip(names, crown, strict=True):
        subroot, paths = tops[name]
        for (key, leaf), path in zip(trees[name], paths, strict=True):
            out.append((key, leaf, subroot, path + above))
    return root, out


def folded(leaf, path):
    for before, after in path:
        leaf = _hash("".join(before) + leaf + "".join(after))
    return leaf


_VARIABLE = re.compile(r"[0-9]|^.{25,}$|[%=&;,:~+]", re.S)


def url_parts(url):
    """Host and path of a url."""
    found = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    return (found[1].translate(_UPPER), found[2]) if found else ("", "")


def url_verdicts(urls, rules, most_children=50, smoothing=4.0, reject_at=0.8, alike_at=1.96):
    """urls to a list of (template, verdict): the whole tree of every host in memory."""
    placed = []
    for url in urls:
        host, path = url_parts(url)
        fits = [(len(r), r, v) for v, r in rules
                if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0]))
                and path.startswith(r[len(r.split("/")[0]):])]
        inner = path.strip("/")
        parts = inner.split("/") if inner else []
        segments = tuple("*" if _VARIABLE.search(p) else p for p in parts)
        placed.append((host, segments, max(fits)[2] if fits else None))
    out = {}
    for host in {p[0] for p in placed}:
        counts = {}
        for h, segments, given in placed:
            if h == host:
                bad, known = counts.get(segments, (0, 0))
                counts[segments] = (bad + (given == "block"), known + (given is not None))
        branch = {s: () for s in counts}
        going, level = set(counts), 0
        while going:
            groups = {}
            for s in going:
                groups.setdefault(branch[s], []).append(s)
            following = set()
            for node, members in groups.items():
                children = {s[level] for s in members if len(s) > level}
                for s in members:
                    if len(members) == 1 or len(s) <= level:
                        branch[s] = node + (("/".join(s[level:]),) if len(s) > level else ())
                    else:
                        branch[s] = (*node, "*" if len(children) > most_children else s[level])
                        following.add(s)
            going, level = following, level + 1

        def sums(length):
            total = {}
            for s, b in branch.items():
                if len(b) >= length:
                    bad, known = total.get(b[:length], (0, 0))
                    total[b[:length]] = (bad + counts[s][0], known + counts[s][1])
            return total

        for level in range(max(map(len, branch.values())), 0, -1):
            nodes, parents = sums(level), sums(level - 1)
            alike = set()
            for node, (bad, known) in nodes.items():
                all_bad, all_known = parents[node[:-1]]
                rest = all_known - known
                apart = False
                if known and rest:
                    pooled = all_bad / all_known
                    spread = math.sqrt(pooled * (1 - pooled) * (1 / known + 1 / rest))
                    apart = abs(bad / known - (all_bad - bad) / rest) > alike_at * spread
                if not apart:
                    alike.add(node)
            branch = {s: (*b[: level - 1], "*", *b[level:]) if b[:level] in alike and len(b) >= level else b
                      for s, b in branch.items()}
        shares = {}
        for level in range(max(map(len, branch.values())) + 1):
            for node, (bad, known) in sums(level).items():
                before = shares[node[:-1]] if level else 0.5
                shares[node] = (bad + smoothing * before) / (known + smoothing)
        judged = sum(k for _, k in counts.values()) > 0
        for s, b in branch.items():
            out[host, s] = ("/" + "/".join(b), judged and shares[b] >= reject_at)
    return [(out[h, s][0], given or ("block" if out[h, s][1] else "allow")) for h, s, given in placed]
