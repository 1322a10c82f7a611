"""Plain-Python versions of the training-data operators for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def fingerprint(text, k=4, seed=42):
    words = WORD.findall(lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(rows, max_distance=4):
    """{doc_id: (fingerprint, smallest reachable doc_id)}"""
    ids, fps = [i for i, _ in rows], [fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= max_distance:
                root[find(a)] = find(b)
    least = {}
    for i in range(len(rows)):
        least[find(i)] = min(least.get(find(i), ids[i]), ids[i])
    return {ids[i]: (f"{fps[i]:016x}", least[find(i)]) for i in range(len(rows))}


def removed(rows, length=100):
    """{doc_id: (n_bytes, n_removed, n_spans, kept_sha256)}"""
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for a in range(len(data) - length + 1):
            piece = data[a:a + length]
            if piece in seen:
                gone[a:a + length] = b"\1" * length
            seen.add(piece)
        kept = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out[i] = (len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest())
    return out


def contamination(rows, items, window=10):
    """{doc_id: (n_words, n_hit, n_items, items_sha256, contaminated)}"""
    windows = {}
    for item, text in items:
        words = BENCH_WORD.findall(lower(text))
        n = min(window, len(words))
        for a in range(len(words) - n + 1 if words else 0):
            windows.setdefault(tuple(words[a:a + n]), set()).add(item)
    out = {}
    for i, text in rows:
        words, hit, found = BENCH_WORD.findall(lower(text)), set(), set()
        for n in {len(w) for w in windows}:
            for a in range(len(words) - n + 1):
                if tuple(words[a:a + n]) in windows:
                    hit.update(range(a, a + n))
                    found |= windows[tuple(words[a:a + n])]
        names = sorted(str(x) for x in found if x is not None)
        out[i] = (len(words), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit))
    return out


def copies(rows, weights=(1, 2, 3), limit=3, seed="mix"):
    """{doc_id: (size, source_size, target, copies)} for rows (doc_id, source, text)."""
    size = {i: len(WORD.findall(t or "")) for i, _, t in rows}
    sources = sorted({s for _, s, _ in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(size[i] for i, o, _ in rows if o == s) for s in sources}
    weight = {s: weights[k % len(weights)] for k, s in enumerate(sources)}
    target, open_ = {}, set(sources)
    while open_:
        rest = sum(total.values()) - sum(target.values())
        share = {s: rest * weight[s] / sum(weight[o] for o in open_) for s in open_}
        full = {s for s in open_ if share[s] >= limit * total[s]}
        if not full:
            target |= share
            break
        target |= {s: float(limit * total[s]) for s in full}
        open_ -= full
    out = {}
    for s in sources:
        ahead = 0
        mine = sorted((hashlib.md5(f"{seed}{i}".encode()).hexdigest(), i, size[i]) for i, o, _ in rows if o == s)
        for _, i, n in mine:
            whole = int(target[s] // total[s]) if total[s] else 0
            more = total[s] and whole < limit and ahead + n / 2 <= target[s] - whole * total[s]
            out[i] = (n, total[s], target[s], whole + bool(more))
            ahead += n
    return out


def tokens(rows, tokenizer, end=2):
    """[(doc_id, start, n_tokens, ids_crc32)] for rows (doc_id, text) in ascending order of id."""
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] or "")):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def url(address, rules, other="allow"):
    """(host, path, rule, verdict); ``other`` is the verdict of pages without a rule."""
    if address is None or "://" not in address:
        return "", "", None, other
    rest = address.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
    host = lower(host)
    fits = [(len(h + p), len(h), v, h + p) for v, h, p in rules
            if h is not None and (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fits)[3], max(fits)[2]) if fits else (host, path, None, other)


def reputations(pages, labels):
    """{host: (labelled, bad, alpha, beta)} for pages (page_id, url, ...) and labels (page_id, bad)."""
    long = {"co.uk"}
    host_of = {i: url(u, [])[0] for i, u, *_ in pages}
    count = {h: [0, 0] for h in host_of.values()}
    for i, bad in labels:
        count[host_of[i]][0] += 1
        count[host_of[i]][1] += bad

    def parents(host):
        site = host.split("@")[-1].split(":")[0]
        parts = site.split(".")
        if re.fullmatch(r"[\d.]+", site):
            return site, "ip"
        k = 2 if ".".join(parts[-2:]) in long else 1
        return ".".join(parts[-k - 1:]), ".".join(parts[-k:])

    def total(children, parent):
        out = {}
        for c, (n, y) in children.items():
            t = out.setdefault(parent(c), [0, 0])
            t[0], t[1] = t[0] + n, t[1] + y
        return out

    domains = total(count, parents)
    suffixes = total(domains, lambda d: d[1])
    n, y = map(sum, zip(*suffixes.values(), strict=True))
    posterior, mean = {}, {None: (y + 1) / (n + 10)}
    for level, parent in ((suffixes, lambda s: None), (domains, lambda d: d[1]), (count, parents)):
        rows = [(n, y, mean[parent(c)]) for c, (n, y) in level.items() if n]
        pairs = sum(n * (n - 1) * m * (1 - m) for n, _, m in rows)
        rho = sum((y - n * m) ** 2 - n * m * (1 - m) for n, y, m in rows) / pairs if pairs > 0 else 0.1
        strength = 1 / min(max(rho, 0.001), 0.999) - 1
        posterior = {c: (y + strength * mean[parent(c)], n - y + strength * (1 - mean[parent(c)])) for c, (n, y) in level.items()}
        mean |= {c: a / (a + b) for c, (a, b) in posterior.items()}
    return {h: (*count[h], *posterior[h]) for h in count}


def manifest(rows):
    """[(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)] for rows (doc_id, source, lang, n_chars, text)."""
    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    def leaf(*values):
        return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([digest("".join(out[-1][i:i + 3])) for i in range(0, len(out[-1]), 3)])
        return out

    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        mine = sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees[s] = (mine, levels([leaf(*r) for r in mine]))
    top = levels([trees[s][1][-1][0] for s in sources]) if rows else []
    out = []
    for k, s in enumerate(sources):
        mine, tree = trees[s]
        for i, r in enumerate(mine):
            cut = r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            now, siblings = leaf(*r[:4], r[4].replace("\n", "") if cut else r[4]), ""
            for walk, at in ((tree, i), (top, k)):
                for level in walk[:-1]:
                    a = at - at % 3
                    siblings += "".join(x for j, x in enumerate(level[a:a + 3], a) if j != at)
                    now = digest("".join(now if j == at else x for j, x in enumerate(level[a:a + 3], a)))
                    at //= 3
            out.append((r[0], tree[0][i], tree[-1][0], top[-1][0], digest(siblings), now, now == top[-1][0]))
    return out


def phrases(rows, max_words=3, min_count=10, share=50, top=2000):
    """[(lang, rank, phrase, a, l, r, n, score)] for rows (lang, text)."""
    count = {}
    for lang, text in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text)):
            words = re.findall("[^\x20\x09]+", piece)
            f = count.setdefault(lang or "und" if lang != "" else "", {})
            for n in range(1, max_words + 1):
                for i in range(len(words) - n + 1):
                    f[tuple(words[i:i + n])] = f.get(tuple(words[i:i + n]), 0) + 1
    out = []
    for lang, f in count.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        inside = {}
        for p, a in candidates.items():
            for n in range(2, len(p)):
                for i in range(len(p) - n + 1):
                    inside[p[i:i + n]] = max(inside.get(p[i:i + n], 0), a)
        kept = []
        for p, a in candidates.items():
            if 100 * inside.get(p, -1) >= share * a:
                continue
            score, k = min((10 ** 6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        n = sum(a for p, a in f.items() if len(p) == 1)
        out += [(lang, i, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(kept)[:top], 1)]
    return out
