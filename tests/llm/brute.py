"""Plain single-process versions of the contracts, for small inputs."""

import base64
import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PII = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def by_none(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


class Groups:
    def __init__(self, items):
        self.parent = {i: i for i in items}

    def find(self, x):
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, x, y):
        x, y = self.find(x), self.find(y)
        self.parent[max(x, y)] = min(x, y)


def near_documents(rows, k, percent):
    """rows: (doc_id, text) -> (doc_id, n_shingles, component, kept)."""
    sets = []
    for _, text in rows:
        w = WORD.findall(lower(text))
        sets.append({tuple(w[i: i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    groups = Groups([i for i, _ in rows if i is not None])
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and None not in (rows[a][0], rows[b][0]):
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    groups.join(rows[a][0], rows[b][0])
    component = lambda i: None if i is None else groups.find(i)
    return [(i, len(s), component(i), component(i) == i) for (i, _), s in zip(rows, sets)]


def repeats(rows, length=200):
    """rows: (doc_id, text) -> (doc_id, n_bytes, n_removed, n_spans, kept hash)."""
    texts = [(t or "").encode() for _, t in rows]
    seen = collections.Counter(t[s: s + length] for t in texts for s in range(len(t) - length + 1))
    out = []
    for (i, _), t in zip(rows, texts):
        spans = []
        for s in range(len(t) - length + 1):
            if seen[t[s: s + length]] > 1:
                if spans and s <= spans[-1][1]:
                    spans[-1][1] = s + length
                else:
                    spans.append([s, s + length])
        edges = [0, *(x for s in spans for x in s), len(t)]
        kept = b"".join(t[a:b] for a, b in zip(edges[::2], edges[1::2]))
        out.append((i, len(t), sum(e - s for s, e in spans), len(spans), sha(kept)))
    return out


def contaminated(rows, items, window=10):
    """rows: (doc_id, text), items: (item_id, text) -> (doc_id, n_words, n_hit, items)."""
    owners = collections.defaultdict(set)
    for item, text in items:
        w = TOKEN.findall(lower(text))
        for k in range(max(1, len(w) - window + 1) if w and item is not None else 0):
            owners[tuple(w[k: k + window])].add(str(item))
    lengths = {len(w) for w in owners}
    out = []
    for i, text in rows:
        w, hit, found = TOKEN.findall(lower(text)), set(), set()
        for n in lengths:
            for s in range(len(w) - n + 1):
                if here := owners.get(tuple(w[s: s + n])):
                    hit.update(range(s, s + n))
                    found |= here
        out.append((i, len(w), len(hit), tuple(sorted(found))))
    return out


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def personal(text):
    """Base spans as kind:start:end texts."""
    def good(kind, value):
        digits = re.sub("[^0-9]", "", value)
        return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in value.split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]

    return [f"{k}:{m.start()}:{m.end()}" for k, p in PII.items() for m in p.finditer(text or "") if good(k, m[0])]


def pii_candidates(text):
    """(start, end, features) of what may be personal data, numbers and written mail addresses."""
    bucket = lambda v, bounds: sum(v >= b for b in bounds)
    local = "A-Za-z0-9._%+-"
    mail = re.compile(rf"(?<![{local}])[{local}]+ ?(?:@|\(at\)|\[at\]|\{{at\}}) ?[A-Za-z0-9-]+(?: ?(?:\.|\(dot\)|\[dot\]|\{{dot\}}) ?[A-Za-z0-9-]+)+")
    for family, pattern in enumerate((re.compile(r"[+(]?[0-9][0-9 ().\-/]{5,}[0-9]"), mail)):
        last = 0
        for m in pattern.finditer(text):
            value = m[0].lstrip("+(") if family == 0 else re.sub(
                r" ?(\.|\(dot\)|\[dot\]|\{dot\}) ?", ".", re.sub(r" ?(@|\(at\)|\[at\]|\{at\}) ?", "@", m[0]))
            before, last = text[last:m.start()][-12:], m.end()
            digits, low = re.sub("[^0-9]", "", value), before.lower()
            cue = next((n for n, w in enumerate(("tel|phone|call|mob|fax", "card|visa|pay", "ip|host|addr", "mail|contact"), 1)
                        if re.search(w, low)), 0)
            octets = value.split(".")
            yield m.start(), m.end(), {
                "family": family, "cue": cue, "dots": bucket(value.count("."), (1, 3, 4)), "paren": int("(" in value[1:65]),
                "length": bucket(len(value), (8, 16, 32)) if family else bucket(len(digits), (8, 10, 12, 14, 16, 20)),
                "parts": bucket(len(re.split("[^A-Za-z0-9]+" if family else "[^0-9]+", value)), (2, 3, 4, 5, 6)),
                "luhn": int(12 <= len(digits) <= 19 and luhn(digits)),
                "octets": int(len(octets) == 4 and all(o.isdigit() and int(o) <= 255 for o in octets)),
                "before": 0 if before[-1:].strip() == "" else 1 if before[-1].isalpha() else 2}


def warc(rows):
    """rows: (page_id, html) -> (page_id, bytes, digest, type, refers_to)."""
    top = {}
    for page, html in rows:
        if page is not None:
            top[html or ""] = max(page, top.get(html or "", page))
    out = []
    for page, html in rows:
        data = (html or "").encode()
        alone = page is None or top[html or ""] == page
        out.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "response" if alone else "revisit", None if alone else top[html or ""]))
    return out


def near_vectors(rows, threshold=0.95):
    """rows: (vec_id, list) -> (vec_id, n_links, component, kept)."""
    import numpy as np

    good = lambda v: bool(v) and all(x is not None for x in v) and np.isfinite(v).all() and any(v)
    groups, links = Groups([i for i, _ in rows if i is not None]), [0] * len(rows)
    unit = [np.array(v) / np.linalg.norm(v) if i is not None and good(v) else None for i, v in rows]
    for a in range(len(rows)):
        for b in range(a):
            if unit[a] is not None and unit[b] is not None and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold:
                links[a] += 1
                links[b] += 1
                groups.join(rows[a][0], rows[b][0])
    component = lambda i: None if i is None else groups.find(i)
    return [(i, n, component(i), component(i) == i) for (i, _), n in zip(rows, links)]
