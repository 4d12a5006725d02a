"""Plain Python versions of the operators, and a small corpus with all odd cases."""

import collections
import hashlib
import math
import random
import re
import struct
import zlib

SPACE_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
ALNUM_WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def corpus():
    """(doc_id, text, lang, source) rows: copies, near copies, shared passages, nulls, empty, short and long texts."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdeéñßrstlmn") for _ in range(rng.randint(2, 8))) for _ in range(900)]

    def text(n):
        return " ".join(rng.choice(vocabulary) + rng.choice(["", "", "", ".", ",\n"]) for _ in range(n))

    rows, passage = [], text(40)
    for i in range(90):
        body = text(rng.randint(60, 160))
        if i % 7 == 0:
            body = f"{body}\n{passage} {text(30)}"
        rows.append([i, body, "en" if i % 4 else "de", f"src{i % 3}" if i % 5 else None])
    for i in range(90, 110):  # near and exact copies of one text
        words = rows[3][1].split(" ")
        if i % 2:
            words[rng.randrange(len(words))] = "changed"
        rows.append([i, " ".join(words), "en", "src0"])
    odd = [None, "", " \n\t ", "one", "one two three", "one two three", "#$% a &&& b", "nul\0byte " * 30, "Ünï cödé 漢字 " * 20,
           "same word " * 80, "line of words here\n" * 40, text(6000)]
    rows += [[110 + k, t, None if k % 3 else "en", "src1"] for k, t in enumerate(odd)]
    rows += [list(rows[8]), list(rows[8])]                       # repeated rows
    rows += [[9, text(70), "en", "src2"], [None, text(70), "en", "src2"], [None, rows[4][1], "fr", "src9"]]
    return rows


def benchmark(rows):
    words = rows[11][1].split()
    return [["b1", " ".join(words[10:24])], ["b2", " ".join(words[30:36])], ["b2", " ".join(words[31:42])], [None, "one two three"],
            ["b4", None], ["b5", ""], ["b6", "none of these words occur anywhere in the corpus at all today"]]


def targets(sizes, weights=(5, 2, 1), epochs=3):
    """Words that each source gives, from the words it has."""
    names = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    full = set()
    while True:
        rest = sum(sizes.values()) - sum(epochs * sizes[s] for s in full)
        heavy = sum(weight[s] for s in names if s not in full)
        target = {s: epochs * sizes[s] if s in full else rest * weight[s] / heavy for s in names}
        over = {s for s in names if target[s] > epochs * sizes[s] + 1e-9}
        if not over:
            return target
        full |= over


def vectors():
    """(vec_id, embedding, label) rows: close groups, ties, repeated rows, nulls, odd components and lengths."""
    rng = random.Random(9)
    rows = []
    for i in range(520):
        centre = [rng.gauss(0, 1) for _ in range(8)] if i % 13 == 0 else centre
        rows.append([i, [c + rng.gauss(0, 0.3) for c in centre], rng.randrange(4)])
    for i in range(520, 560):  # ties
        rows.append([i, [1.0, 0, 0, 0, 0, 0, 0, 0.5], i % 4])
    rows += [list(rows[50]), list(rows[50]), list(rows[523]), [None, rows[50][1], 1], [600, None, 1], [650, rows[3][1], None],
             [700, [0.5, None] * 4, 2], [750, [float("nan")] * 8, 2], [800, [float("inf")] + [0.0] * 7, 2], [850, [], 2],
             [900, [2.0, -1.0, 0.5], 3], [950, [0.0] * 8, 0], [-50, rows[60][1], 2], [1000, [300.0] * 8, 1]]
    return rows


def hard_negatives(rows):
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) rows."""
    items = []
    for key, vector, label in rows:
        if key is not None and label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            exact = struct.unpack(f"{len(vector)}f", struct.pack(f"{len(vector)}f", *vector))
            items.append((key, (label + 1) % 10 if key % 7 == 0 else label, [math.floor(256 * x) for x in exact]))
    out = []
    for a, (key, label, q) in enumerate(items):
        if key % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, p)), other, its) for b, (other, its, p) in enumerate(items) if b != a)
        for s, positive, _ in [x for x in scored if x[2] == label][:5]:
            inside = [(t, other) for t, other, its in scored if its != label and 50 * -s <= 100 * -t <= 95 * -s]
            out += [(key, positive, k + 1, other, -s, -t) for k, (t, other) in enumerate(inside[:3])]
    return out


def grams(text):
    words = SPACE_WORDS.findall((text or "").encode())
    n = min(5, len(words))
    return frozenset(tuple(words[k:k + n]) for k in range(len(words) - n + 1)) if words else frozenset()


def near(rows):
    """(id, class_id, n_links) per row."""
    sets = [grams(r[1]) for r in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    links = [0] * len(rows)
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and len(a & b) >= 0.8 * len(a | b) - 1e-9:
                links[i] += 1
                links[j] += 1
                up[root(i)] = root(j)
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[root(i)] = min(low.get(root(i), r[0]), r[0])
    return [(r[0], low.get(root(i)), links[i]) for i, r in enumerate(rows)]


def statistics(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
    often = collections.Counter(windows)
    covered = {k + d for k, w in enumerate(windows) if often[w] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def hits(rows, items):
    """(id, n_words, n_hit, n_items, sha256) per row."""
    def words(text):
        return ALNUM_WORDS.findall((text or "").encode().translate(LOWER))

    phrases = collections.defaultdict(set)
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        for k in range(len(w) - n + 1) if n else ():
            phrases[tuple(w[k:k + n])].add(item)
    out = []
    for r in rows:
        w, hit, found = words(r[1]), set(), set()
        for n in {len(p) for p in phrases}:
            for k in range(len(w) - n + 1):
                if (p := tuple(w[k:k + n])) in phrases:
                    hit.update(range(k, k + n))
                    found |= phrases[p]
        names = sorted(x for x in found if x is not None)
        out.append((r[0], len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest()))
    return out


def cut(rows, window=50):
    """(id, n_bytes, n_removed, n_spans, sha256) per row."""
    texts = [(r[0], (r[1] or "").encode()) for r in rows]
    first = {}
    for i, t in texts:
        if i is not None:
            for k in range(len(t) - window + 1):
                s = t[k:k + window]
                first[s] = min(first.get(s, i), i)
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for k in range(len(t) - window + 1) if i is not None else ():
            if first[t[k:k + window]] < i:
                gone[k:k + window] = b"\1" * window
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((i, len(t), sum(gone), len(re.findall(rb"\x01+", gone)), hashlib.sha256(kept).hexdigest()))
    return out


def base_scores(rows):
    """(id, held_out, n_tokens, n_known, N, base score) per row."""
    tokens = [(r[0], SPACE_WORDS.findall((r[1] or "").encode().translate(LOWER)) + [None]) for r in rows]
    out = [zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, _ in tokens]
    counts = collections.Counter(w for (_, t), o in zip(tokens, out) if not o for w in t)
    total, distinct = sum(counts.values()), len(counts)
    return [(i, o, len(t), sum(counts[w] > 0 for w in t), total,
             round(sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in t), 6))
            for (i, t), o in zip(tokens, out)]


def trained_scores(rows, least=2, discount=0.7, add=0.1):
    """(id, score) per row by all bigrams and trigrams that occur ``least`` times, step by step."""
    tokens = [(r[0], SPACE_WORDS.findall((r[1] or "").encode().translate(LOWER)) + [None]) for r in rows]
    train = [t for i, t in tokens if zlib.crc32(("" if i is None else str(i)).encode()) % 10]
    counts = [collections.Counter(tuple(t[k:k + n]) for t in train for k in range(len(t) - n + 1)) for n in (1, 2, 3)]
    total, distinct = sum(counts[0].values()), len(counts[0])
    arcs = collections.defaultdict(list)
    for kept in counts[1:]:
        for gram, n in kept.items():
            if n >= least:
                arcs[gram[:-1]].append(gram)

    def own(gram):
        return (counts[len(gram) - 1][gram] - discount) / counts[len(gram) - 2][gram[:-1]]

    def p(gram):
        if len(gram) == 1:
            return (counts[0][gram] + add) / (total + add * (distinct + 1))
        if counts[len(gram) - 1][gram] >= least:
            return own(gram)
        return fail(gram[:-1]) * p(gram[1:])

    weights = {}

    def fail(context):
        if context not in weights:
            grams = arcs.get(context, [])
            weights[context] = (1 - sum(map(own, grams))) / (1 - sum(p(g[1:]) for g in grams))
        return weights[context]

    return [(i, sum(math.log10(p(tuple(t[max(k - 2, 0):k + 1]))) for k in range(len(t)))) for i, t in tokens]
