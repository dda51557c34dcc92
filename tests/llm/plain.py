"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
WHITE = " \t\n\v\f\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(LOWER))


def shingles(text: str | None, size: int = 5) -> frozenset:
    found = words(text)
    if not found:
        return frozenset()
    return frozenset(tuple(found[i:i + size]) for i in range(max(1, len(found) - size + 1)))


def jaccard_groups(rows: list[tuple], percent: int = 75) -> dict:
    """(n_shingles, component) by doc_id."""
    sets = {doc_id: shingles(text) for doc_id, text in rows}
    parent = {doc_id: doc_id for doc_id in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    return {doc_id: (len(x), find(doc_id)) for doc_id, x in sets.items()}


def exact_groups(rows: list[tuple]) -> dict:
    """(keep_id, group_size) by doc_id."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        text = text or ""
        groups["".join(c for c in text if c not in WHITE)].append((-len(text), doc_id))
    return {doc_id: (min(group)[1], len(group)) for group in groups.values()
            for _, doc_id in group}


def dedup_lines(rows: list[tuple], least: int = 10) -> dict:
    """(kept text, lines, dropped lines) by doc_id."""
    split = {doc_id: (text or "").split("\n") for doc_id, text in rows}
    key = lambda line: line.strip(WHITE).translate(LOWER)
    holders = defaultdict(set)
    for doc_id, lines in split.items():
        for line in lines:
            if len(key(line)) >= least:
                holders[key(line)].add(doc_id)
    out = {}
    for doc_id, lines in split.items():
        stay = [line for line in lines if key(line) not in holders
                or min(holders[key(line)]) == doc_id]
        out[doc_id] = ("\n".join(stay), len(lines), len(lines) - len(stay))
    return out


def base_scores(rows: list[tuple], learns) -> dict:
    """(tokens, known tokens, base score) by doc_id."""
    tokens = {doc_id: [*words(text), None] for doc_id, text in rows}
    counts = Counter(t for doc_id, found in tokens.items() if learns(doc_id) for t in found)
    total, kinds = sum(counts.values()), len(counts)
    return {doc_id: (len(found), sum(counts[t] > 0 for t in found),
                     sum(math.log10((counts[t] + 1) / (total + kinds + 1)) for t in found))
            for doc_id, found in tokens.items()}


# Personal data, spelling variants, ranked search.

BASE = {"email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
        "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")}
TERM = re.compile(r"[^\W_]+")


def _right(kind: str, value: str) -> bool:
    digits = [int(c) for c in value if c in "0123456789"]
    if kind == "ip":
        return all(int(part) <= 255 for part in value.split("."))
    if kind == "card":
        twice = [sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(twice) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def personal(text: str | None) -> list[tuple]:
    """(start, order, end, kind, value) of the base spans."""
    return sorted((m.start(), order, m.end(), kind, m.group())
                  for order, (kind, pattern) in enumerate(BASE.items())
                  for m in pattern.finditer(text or "") if _right(kind, m.group()))


def disclosing(texts: list[str | None], near: int = 6, reach: int = 120, support: int = 3,
               diversity: float = 0.5, threshold: float = 0.9) -> dict:
    """The terms that disclose, with how much, from all different texts."""
    texts = sorted({t or "" for t in texts})
    cut = lambda found, left, at: found[at:] if left else found
    holders, around, entities = defaultdict(set), defaultdict(set), defaultdict(set)
    for number, text in enumerate(texts):
        per_kind = defaultdict(list)
        for span in personal(text):
            per_kind[span[3]].append(span)
        for kind, spans in per_kind.items():
            edges = [m.span() for m in BASE[kind].finditer(text)]
            for start, _, end, _, value in spans:
                at = edges.index((start, end))
                before = text[edges[at - 1][1] if at else 0:start][-reach:]
                after = text[end:edges[at + 1][0] if at + 1 < len(edges) else None][:reach]
                left = [w for w in TERM.findall(before.lower()) if len(w) >= 3]
                right = [w for w in TERM.findall(after.lower()) if len(w) >= 3]
                left = cut(left, len(before) == reach, 1)[-near:]
                right = (right[:-1] if len(after) == reach else right)[:near]
                bare = (value.lower() if kind == "email" else
                        ".".join(str(int(p)) for p in value.split(".")) if kind == "ip" else
                        "".join(c for c in value if c.isdigit()))
                entities[kind, bare].add(number)
                for word in {*left, *right}:
                    holders[(kind, bare), word].add(number)
                    around[(kind, bare), word].add((tuple(left), tuple(right)))
    words_of = [{w for w in TERM.findall(t.lower()) if len(w) >= 3} for t in texts]
    found: dict = {}
    for (name, word), held in holders.items():
        some = len(around[name, word])
        if len(held) < support or some < support or some < diversity * len(held):
            continue
        own = math.log(len(texts) / len(entities[name]))
        if own > 0:
            share = (own + math.log(len(held) / sum(word in w for w in words_of))) / own
            if share >= threshold:
                found[word] = max(share, found.get(word, share))
    return found


RUN = re.compile("[A-Za-zÀ-ÿ]+")


def variants(rows: list[tuple], least: int = 7, count: int = 2, ratio: int = 10,
             one_in: int | None = 31) -> dict:
    """(form, root, n, n_near, form_n) by word, from all pairs of words."""
    counts: Counter = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            word = run.translate(LOWER)
            name = "" if doc_id is None else doc_id
            check = zlib.crc32(f"{name}:{word}".encode())
            if one_in and check % one_in == 0:
                at = check % len(word)
                word = word[:at] + word[at + 1:]
            counts[word] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= least and n >= count}

    def near(a: str, b: str) -> bool:
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        short, long = sorted((a, b), key=len)
        return (len(long) - len(short) == 1
                and any(long[:i] + long[i + 1:] == short for i in range(len(long))))

    forms, n_near = {}, {}
    for word, n in counts.items():
        others = [x for x in counts if near(word, x)]
        n_near[word] = len(others)
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        forms[word] = best if best and counts[best] >= ratio * n else None

    def root(word: str) -> str:
        return root(forms[word]) if forms[word] else word

    return {w: (forms[w], root(w), n, n_near[w], counts.get(forms[w])) for w, n in counts.items()}


SEARCHED = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def search(docs: list[tuple], items: list[tuple], best: int = 20) -> list[tuple]:
    """(item_id, rank, doc_id, score) of each item, by scoring every document."""
    split = lambda text: SEARCHED.findall((text or "").translate(LOWER))
    counted = [(doc_id, Counter(split(text))) for doc_id, text in docs]
    counted = [(doc_id, c, sum(c.values())) for doc_id, c in counted if c]
    total, holding = sum(n for _, _, n in counted), Counter()
    for _, counts, _ in counted:
        holding.update(counts.keys())
    found = []
    for item_id, text in items:
        scores = []
        for doc_id, counts, n in counted:
            m = 75 + 25 * n * len(counted) // total
            score = sum(math.floor(1000 * math.log((2 * len(counted) + 2) / (2 * holding[t] + 1)))
                        * (10 ** 9 * counts[t] // (1000 * counts[t] + 12 * m))
                        for t in split(text) if counts[t])
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        found += [(item_id, rank, row[3], -row[0])
                  for rank, row in enumerate(sorted(scores, key=lambda r: r[:3])[:best], 1)]
    return found


def suffix_tree_scores(rows: list[tuple], learns, depth: int = 3, repeats: int = 3,
                       least: int = 8, leaning: float = 2.0, divergence: float = 3.0
                       ) -> tuple[dict, dict]:
    """(score by doc_id, number of states by length) of a suffix tree over words."""
    end = None
    tokens = {doc_id: (*words(text), end) for doc_id, text in rows}
    learned = [found for doc_id, found in tokens.items() if learns(doc_id)]
    counts = Counter(t for found in learned for t in found)
    whole = sum(counts.values()) + len(counts) + 1
    root = {t: (n + 1) / whole for t, n in counts.items()}
    contexts = {(t,): n for t, n in counts.items() if n >= least and t is not end}
    shares, backing, sizes = {}, {}, {}
    for length in range(1, depth + 1):
        runs = Counter((found[i - length:i], found[i]) for found in learned
                       for i in range(length, len(found)))
        level: dict = defaultdict(dict)
        for (context, token), n in runs.items():
            shorter = root.get(token) if length == 1 else shares.get((context[1:], token))
            if n >= repeats and context in contexts and shorter is not None:
                level[context][token] = n, shorter
        for context, entries in level.items():
            count = contexts[context]
            share = {t: (n + leaning * s) / (count + leaning) for t, (n, s) in entries.items()}
            back = (max(1 - sum(share.values()), 1e-12)
                    / max(1 - sum(s for _, s in entries.values()), 1e-12))
            gain = sum(n * math.log(share[t] / s) for t, (n, s) in entries.items())
            gain += (count - sum(n for n, _ in entries.values())) * math.log(back)
            state = gain > divergence * (1 + len(entries))
            if state:
                backing[context] = math.log10(back)
                sizes[length] = sizes.get(length, 0) + 1
            for t, (_, s) in entries.items():
                shares[context, t] = share[t] if state else s
        contexts = {(*c, t): n for c, entries in level.items()
                    for t, (n, _) in entries.items() if n >= least and t is not end}

    def score(found: tuple) -> float:
        total = 0.0
        for i, token in enumerate(found):
            log, covered = 0.0, False
            for length in range(1, min(i, depth) + 1):
                context = found[i - length:i]
                if context in backing:
                    listed = (context, token) in shares
                    log = math.log10(shares[context, token]) if listed else log + backing[context]
                    covered = covered or listed
            total += log if covered else log + math.log10((counts[token] + 1) / whole)
        return total

    return {doc_id: score(found) for doc_id, found in tokens.items()}, sizes
