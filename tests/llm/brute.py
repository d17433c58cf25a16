"""Plain versions of the corpus operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def shingles(tokens, width=5):
    return [tuple(tokens[k : k + width]) for k in range(max(1, len(tokens) - width + 1))] if tokens else []


class Groups:
    """Disjoint sets of numbers."""

    def __init__(self, members):
        self.parent = {one: one for one in members}

    def find(self, one):
        while self.parent[one] != one:
            one = self.parent[one]
        return one

    def tie(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def near_groups(rows, threshold=0.8):
    """(doc_id, links, class) per row, by comparing all sets."""
    sets = [frozenset(shingles(words(text))) for _, text in rows]
    usable = [k for k in range(len(rows)) if sets[k]]
    groups, links = Groups(range(len(rows))), Counter()
    for at, a in enumerate(usable):
        for b in usable[at + 1 :]:
            both = len(sets[a] & sets[b])
            if both >= threshold * (len(sets[a]) + len(sets[b]) - both) - 1e-9:
                links[a] += 1
                links[b] += 1
                groups.tie(a, b)
    least = {}
    for k in usable:
        root = groups.find(k)
        ids = [one for one in (least.get(root), rows[k][0]) if one is not None]
        least[root] = min(ids, default=None)
    known = set(usable)
    return [(rows[k][0], links[k], least[groups.find(k)] if k in known else rows[k][0]) for k in range(len(rows))]


def leaks(rows, items, threshold=0.8):
    """{(doc_id, item_id): similarity} from the items' shingles anywhere in the document."""
    parts = {item: set(shingles(words(text))) for item, text in items if words(text)}
    seen = Counter(one for part in parts.values() for one in part)
    found = {}
    for doc_id, text in rows:
        own = set(shingles(words(text)))
        for item, part in parts.items():
            share = sum(1 / seen[one] for one in part & own) / sum(1 / seen[one] for one in part)
            if share >= threshold - 1e-9 and doc_id is not None:
                found[doc_id, item] = share
    return found


def mix_targets(sizes, weights=(1, 2, 3), ceiling=3):
    """Targets by reapportioning again and again."""
    order = sorted(sizes, key=lambda name: (name is None, name or ""))
    weight = {name: weights[k % len(weights)] for k, name in enumerate(order)}
    total = sum(sizes.values())
    full = set()
    while True:
        left = total - sum(ceiling * sizes[name] for name in full)
        share = sum(weight[name] for name in order if name not in full)
        now = {name: ceiling * sizes[name] if name in full else left * weight[name] / share for name in order}
        more = {name for name in order if now[name] > ceiling * sizes[name] + 1e-9}
        if not more:
            return now
        full |= more


def mix(rows):
    """(doc_id, size, taken, copies) of (doc_id, source, text)."""
    sized = [(doc_id, source, len(words(text))) for doc_id, source, text in rows]
    sizes = Counter()
    for _, source, size in sized:
        sizes[source] += size
    targets = mix_targets(sizes)
    out = []
    for source, target in targets.items():
        budget = math.floor(target + 0.5)
        passes, rest = divmod(budget, sizes[source]) if sizes[source] else (0, 0)
        place = lambda one: int(hashlib.md5(f"mix:{'' if one[0] is None else one[0]}".encode()).hexdigest()[:15], 16)
        before = 0
        for doc_id, _, size in sorted((one for one in sized if one[1] == source), key=lambda one: (place(one), one[2])):
            taken = passes * size + max(0, min(size, rest - before))
            out.append((doc_id, size, taken, passes + (rest > 0 and 2 * before + size <= 2 * rest)))
            before += size
    return out


def text_key(text):
    return int(hashlib.md5((text or "").encode()).hexdigest()[:15], 16)


def greedy_shards(sizes, shards=8):
    """Cuts of ordered group sizes at the least capacity; the number of the shard of each."""

    def fill(capacity):
        numbers, held = [], 0
        for size in sizes:
            if size > capacity:
                return None
            if not numbers:
                numbers, held = [0], size
            elif held + size <= capacity:
                numbers.append(numbers[-1])
                held += size
            else:
                numbers.append(numbers[-1] + 1)
                held = size
        return numbers if not numbers or numbers[-1] < shards else None

    low, high = 0, sum(sizes)
    while low < high:
        middle = (low + high) // 2
        if fill(middle) is None:
            low = middle + 1
        else:
            high = middle
    return low, fill(low)


def backoff_scores(rows, order=3, alpha=0.4, unseen=0.5):
    every = [words(text) for _, text in rows]
    own = [
        Counter(tuple(one[i - n + 1 : i + 1]) for n in range(1, order + 1) for i in range(n - 1, len(one))) for one in every
    ]
    total = sum(own, Counter())
    size = sum(map(len, every))
    out = []
    for (doc_id, _), one, mine in zip(rows, every, own, strict=True):
        score = 0.0
        for i in range(len(one)):
            highest = min(order, i + 1)
            for n in range(highest, 0, -1):
                gram = tuple(one[i - n + 1 : i + 1])
                count = total[gram] - mine[gram]
                if n == 1:
                    part = max(count, unseen) / max(size - len(one), 1)
                elif count > 0:
                    part = count / (total[gram[:-1]] - mine[gram[:-1]])
                else:
                    continue
                score += math.log(part * alpha ** (highest - n))
                break
        out.append((doc_id, len(one), score))
    return out


def licenses(rows, notices, threshold=0.8):
    def plain(text):
        return [one for one in re.split(r"[\W_]+", (text or "").lower()) if one]

    parts = {name: set(shingles(plain(text))) for name, text in notices.items() if plain(text)}
    found = {}
    for doc_id, text in rows:
        own = set(shingles(plain(text)))
        for name, part in parts.items():
            share = len(part & own) / len(part)
            if share >= threshold - 1e-9 and doc_id is not None:
                found[doc_id, name] = share
    return found


def grouped(pairs):
    out = defaultdict(list)
    for key, value in pairs:
        out[key].append(value)
    return out
