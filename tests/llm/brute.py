"""Plain versions of the operators, written apart from them, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict
from math import comb, log10
from zlib import crc32

import xxhash

UPPER = {i: i + 32 for i in range(65, 91)}
BLANK_WORD = re.compile(r"[^\x20\x09-\x0D]+")
NAME_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return (text or "").translate(UPPER)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def contamination(text, items, size=13):
    w, hit, found = NAME_WORD.findall(lower(text)), set(), set()
    for item, body in items:
        b = NAME_WORD.findall(lower(body))
        n = min(size, len(b))
        for i in range(len(b) - n + 1 if n else 0):
            for j in range(len(w) - n + 1):
                if w[j : j + n] == b[i : i + n]:
                    hit.update(range(j, j + n))
                    found.add("" if item is None else str(item))
    return len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit) and 20 * len(hit) >= len(w)


def signals(text):
    text = text or ""
    w = BLANK_WORD.findall(text)
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    inside = {k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if BLANK_WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * len(inside) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(inside), failed


def tail(k, n, p):
    return sum(comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1))


def simhash(text):
    w = BLANK_WORD.findall(lower(text))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near(prints, radius=4):
    """Smallest position reachable per position."""
    root = list(range(len(prints)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return [top(i) for i in range(len(prints))]


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def personal(text):
    """Base spans as (start, kind number, end)."""
    text, out = text or "", []
    tests = [
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub("[^0-9]", "", m)) <= 15),
    ]
    for kind, (pattern, test) in enumerate(tests):
        out += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if test(m[0])]
    return sorted(out)


def unigram(rows):
    """(held_out, n_tokens, n_known, train_tokens, base_score) per row of (key, text)."""
    tokens = [BLANK_WORD.findall(lower(t)) + ["\n"] for _, t in rows]
    held = [crc32(("" if k is None else str(k)).encode()) % 5 == 1 for k, _ in rows]
    c = Counter(w for t, h in zip(tokens, held) if not h for w in t)
    n, v = sum(c.values()), len(c)
    return [
        (h, len(t), sum(c[w] > 0 for w in t), n, sum(log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)) for t, h in zip(tokens, held)
    ]


PHRASES = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl", ("all", "rights", "reserved"): "reserved"}


def licenses(text):
    w = NAME_WORD.findall(lower(text))
    places = [(i, label) for phrase, label in PHRASES.items() for i in range(len(w)) if tuple(w[i : i + len(phrase)]) == phrase]
    at = [i for i, _ in places]
    return len(w), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def targets(sizes, weights=(5, 2, 1), most=3):
    """Targets per source: shares by weight, limited, the excess shared again until nothing is above its limit."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in full)
        open_ = sum(weight[s] for s in names if s not in full)
        out = {s: most * sizes[s] if s in full else left * weight[s] / open_ for s in names}
        over = {s for s in names if s not in full and out[s] >= most * sizes[s]}
        if not over:
            return out
        full |= over


def conversations(rows):
    """(n_turns, turns_sha256, loss_chars, loss_sha256) per conversation of rows (conv, turn, role, text)."""
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for _, _, r, t in turns)), len(loss), sha(loss))
    return out


def damaged_words(docs, fewest=5, damage=199):
    count = Counter()
    for key, text in docs:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = crc32(f"{'' if key is None else key}:{run}".encode())
            if h % damage == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            if len(run) >= 6:
                count[run] += 1
    return {w: n for w, n in count.items() if n >= fewest}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants(count):
    near, form = {w: [v for v in count if one_edit(w, v)] for w in count}, {}
    for w in count:
        if near[w]:
            best = min(near[w], key=lambda v: (-count[v], v))
            if count[best] >= 5 * count[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), count[w], len(near[w]), count[form[w]] if w in form else None) for w in count}


def trie(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in convs.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in own:
        h = crc32(str(c).encode()) % 9
        turns = tuple(own.get(c - c % 5, [])[:h] + own[c][h:])
        ends[turns].append(c)
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        saved[node] = sum(saved[k] for k in children[node]) + ((len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0)
    return sorted(
        (min(m), len(node), min(members[node[:-1]]) if node else -1, len(m), len(children[node]), leaves[node], saved[node], sha(",".join(map(str, sorted(ends[node])))))
        for node, m in members.items()
    )


def best_two_fit(lengths, capacity):
    """Sequence by sequence, piece by piece."""
    left, out = sorted(lengths), []
    while left:
        own, gap = [], capacity
        while any(n <= gap for n in left):
            n = max(n for n in left if n <= gap)
            left.remove(n)
            own.append(n)
            gap -= n
        if gap and len(own) > 1:
            least, best = min(own), None
            for i, a in enumerate(left):
                for b in left[i + 1 :]:
                    if least < a + b <= gap + least and (best is None or (a + b, b) > best):
                        best = (a + b, b)
            if best:
                own.remove(least)
                own += [best[1], best[0] - best[1]]
                left.remove(best[1])
                left.remove(best[0] - best[1])
                left = sorted([*left, least])
        out.append(sorted(own, reverse=True))
    return out


class PlainTree:
    """The suffix tree with dictionaries: contexts are tuples, the newest word last; an end stands before a text."""

    def __init__(self, texts, least_context=10, least_pair=2, divergence=0.02, smoothing=2.0):
        unigram_counts = Counter(w for words in texts for w in words)
        self.n, self.v = sum(unigram_counts.values()), len(unigram_counts)
        self.words, self.levels = unigram_counts, []
        depth = 0
        while True:
            depth += 1
            seen = defaultdict(Counter)
            for words in texts:
                line = ["\n", *words]
                for i in range(depth, len(line)):
                    seen[tuple(line[i - depth : i])][line[i]] += 1
            level = {}
            for context, after in seen.items():
                total = sum(after.values())
                if total < least_context or (depth > 1 and context[1:] not in self.levels[-1]):
                    continue
                kept = {w: n for w, n in after.items() if n >= least_pair}
                if not kept:
                    continue
                below = {w: self.log_p(context[1:], w) for w in kept}
                rest, other = total - sum(kept.values()), max(1 - sum(10**q for q in below.values()), 1e-12)
                gain = sum(n / total * (log10(n / total) - below[w]) for w, n in kept.items())
                gain += rest / total * (log10(rest / total) - log10(other)) if rest else 0
                if gain >= log10(2.718281828459045) * divergence:
                    p = {w: (n + smoothing * 10 ** below[w]) / (total + smoothing) for w, n in kept.items()}
                    level[context] = p, log10(max(1 - sum(p.values()), 1e-12) / other)
            if not level:
                return
            self.levels.append(level)

    def log_p(self, context, word):
        """In the state of the longest suffix of ``context`` reached state by state."""
        score = log10((self.words[word] + 0.5) / (self.n + 0.5 * (self.v + 1)))
        for depth, level in enumerate(self.levels[: len(context)], 1):
            state = level.get(context[-depth:])
            if state is None:
                break
            score = log10(state[0][word]) if word in state[0] else score + state[1]
        return score

    def score(self, words):
        line = ["\n", *words]
        return sum(self.log_p(tuple(line[max(0, i - len(self.levels)) : i]), line[i]) for i in range(1, len(line)))
