"""Plain single-machine versions of the operators, written from their contracts."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def encoded(texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def quality(text):
    text = text or ""
    words = WORDS.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            dup += line in seen
            seen.add(line)
    windows = defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i:i + 8])].append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(8)}
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed)


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def personal(text):
    text = text or ""
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= sum(c in "0123456789" for c in m[0]) <= 15]
    return out


def secrets(text):
    text = text or ""
    found = re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.A)
    out = [("assign", m.start(), m.end()) for m in found if len(m[2]) >= 6]
    out += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return out + [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]


def span_row(spans, kinds):
    spans = sorted(spans, key=lambda s: (s[1], kinds.index(s[0])))
    count = Counter(s[0] for s in spans)
    return (*(count[k] for k in kinds), sha(",".join(f"{k}:{a}:{b}" for k, a, b in spans)))


def contamination(docs, items):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for item, text in items:
        words = pattern.findall((text or "").translate(LOWER))
        size = min(10, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            windows[tuple(words[i:i + size])].add(str(item))
    sizes = {len(w) for w in windows}
    out = {}
    for doc, text in docs:
        words = pattern.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                if w := windows.get(tuple(words[i:i + size])):
                    hit.update(range(i, i + size))
                    found |= w
        out[doc] = (len(words), len(hit), len(found), sha(",".join(sorted(found))), bool(hit))
    return out


def shingle_sets(docs):
    out = {}
    for doc, text in docs:
        words = WORDS.findall((text or "").translate(LOWER))
        if len(words) >= 4:
            out[doc] = {tuple(words[i:i + 4]) for i in range(len(words) - 3)}
        else:
            out[doc] = {tuple(words)} if words else set()
    return out


def jaccard_components(docs):
    sets = shingle_sets(docs)
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            parent[d] = parent[parent[d]]
            d = parent[d]
        return d

    holders = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    overlap = Counter()
    for own in holders.values():
        own = sorted(own)
        for i, a in enumerate(own):
            for b in own[i + 1:]:
                overlap[a, b] += 1
    for (a, b), n in overlap.items():
        if 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {d: (len(s), root(d)) for d, s in sets.items()}


def repeated_bytes(docs, size=50):
    first = {}
    raw = {d: (t or "").encode() for d, t in docs}
    for d in sorted(raw):
        for i in range(len(raw[d]) - size + 1):
            first.setdefault(raw[d][i:i + size], d)
    out = {}
    for d, b in raw.items():
        gone = np.zeros(len(b) + 1, dtype=int)
        for i in range(len(b) - size + 1):
            if first[b[i:i + size]] < d:
                gone[i] += 1
                gone[i + size] -= 1
        mask = np.cumsum(gone)[:-1] > 0
        spans = int(mask[:1].sum() + (mask[1:] & ~mask[:-1]).sum()) if len(b) else 0
        out[d] = (len(b), int(mask.sum()), spans, sha(bytes(np.frombuffer(b, dtype=np.uint8)[~mask])))
    return out


def merkle(rows):
    """One entry per row (doc_id, source, lang, n_chars, text): leaf, subroot, root, proof, folded root, in the order of the leaves."""
    def digest(values):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    def climb(nodes, at):
        """Root of the nodes and, for the node at ``at``, its siblings to the left and right by level."""
        steps = []
        while len(nodes) > 1:
            first = at // 3 * 3
            steps.append(("".join(nodes[first:at]), "".join(nodes[at + 1:first + 3])))
            nodes, at = [sha("".join(nodes[i:i + 3])) for i in range(0, len(nodes), 3)], at // 3
        return nodes[0], steps

    groups = defaultdict(list)
    for row in rows:
        text = row[4]
        if row[0] is not None and text is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
            text = text.replace("\n", "")
        groups[row[1]].append((row[0] is not None, row[0] or 0, digest(row), digest((*row[:4], text))))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: sorted(groups[g]) for g in names}
    subroots = [climb([x[2] for x in trees[g]], 0)[0] for g in names]
    out = []
    for k, g in enumerate(names):
        for at, (named, doc, leaf, claim) in enumerate(trees[g]):
            subroot, steps = climb([x[2] for x in trees[g]], at)
            root, more = climb(subroots, k)
            folded = claim
            for a, b in steps + more:
                folded = sha(a + folded + b)
            out.append((doc if named else None, leaf, subroot, root, sha("".join(a + b for a, b in steps + more)), folded, folded == root))
    return out


def cosine_groups(rows, least=0.93):
    """(n_links, component) per row (vec_id, embedding, label)."""
    unit, parent = [], list(range(len(rows)))
    for _, e, label in rows:
        good = e and label is not None and all(v is not None and np.isfinite(v) for v in e) and any(e)
        unit.append(np.array(e, dtype=float) / np.linalg.norm(np.array(e, dtype=float)) if good else None)

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    links = [0] * len(rows)
    for i, a in enumerate(unit):
        for j in range(i):
            b = unit[j]
            if a is not None and b is not None and len(a) == len(b) and rows[i][2] == rows[j][2] and a @ b >= least:
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    least_id = defaultdict(list)
    for k, r in enumerate(rows):
        least_id[root(k)].append(r[0])
    return [(r[0], links[k], min(least_id[root(k)]) if unit[k] is not None else r[0]) for k, r in enumerate(rows)]


def codes(rows, parts=16, entries=64, rounds=2):
    """(vec_id, code, error, label_error) per kept row (vec_id, embedding, label), and the codebooks' checksum."""
    kept = sorted(((v, [int(np.floor(256.0 * x)) for x in e], label) for v, e, label in rows if e and all(x is not None and np.isfinite(x) for x in e)),
                  key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = np.array([r[1] for r in kept], dtype=object).reshape(len(kept), parts, -1)
    books = [[list(v) for v in whole[:entries, p]] for p in range(parts)]

    def assign(p):
        own = np.array(books[p], dtype=np.int64)
        far = ((whole[:, p].astype(np.int64)[:, None, :] - own[None]) ** 2).sum(axis=2)
        return far.argmin(axis=1), far.min(axis=1)

    for _ in range(rounds):
        for p in range(parts):
            best, _ = assign(p)
            for k in range(len(books[p])):
                mine = whole[best == k, p]
                if len(mine):
                    books[p][k] = [int(c) // len(mine) for c in mine.sum(axis=0)]
    found = [assign(p) for p in range(parts)]
    errors = [int(sum(f[1][i] for f in found)) for i in range(len(kept))]
    sums = Counter()
    for r, e in zip(kept, errors):
        sums[r[2]] += e
    flat = ",".join(str(c) for book in books for entry in book for c in entry)
    return [(r[0], "".join(f"{f[0][i]:02x}" for f in found), errors[i], sums[r[2]]) for i, r in enumerate(kept)], sha(flat)
