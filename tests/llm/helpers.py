"""Small tables with every odd case, and brute-force versions of the operators."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, label int, n_words int"


def documents(spark, texts, **columns):
    """Documents 0, 1, ... with clashing further columns; ``columns`` overrides by position."""
    rows = []
    for n, text in enumerate(texts):
        row = {"doc_id": n, "text": text, "lang": "en", "source": f"src{n % 3}", "n_chars": len(text or "")}
        row |= {k: v[n] for k, v in columns.items()}
        rows.append((row["doc_id"], row["text"], row["lang"], row["source"], row["n_chars"], "clash", 7, -1))
    return spark.createDataFrame(rows, SCHEMA)


def prose(n, seed=0, words=60):
    """Distinct texts of invented words."""
    import random

    made = random.Random(seed)
    parts = ["ka", "lo", "mi", "ner", "tu", "sal", "vor", "en", "ti", "gra"]
    return [" ".join("".join(made.choices(parts, k=made.randint(1, 4))) for _ in range(words)) for _ in range(n)]


ODD_TEXTS = [
    None, "", " \n\t ", "one", "two words", "é𝒳ü 😀  nbsp", "x" * 5000, "a b c d e f g h " * 40, "9 " * 3000,
    "line\nline\n\nother line\nline", "UPPER CASE TEXT!! " * 10,
]


def lower_ascii(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text, width):
    words = WORD.findall(lower_ascii(text or ""))
    if len(words) < width:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def smallest_relatives(ids, linked):
    """Smallest id of each row's component, by rows; missing ids count last."""
    parent = list(range(len(ids)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        parent[root(a)] = root(b)
    groups = {}
    for n in range(len(ids)):
        groups.setdefault(root(n), []).append(ids[n])
    return [min((i for i in groups[root(n)] if i is not None), default=None) for n in range(len(ids))]


def near_pairs(texts, width, percent):
    sets = [shingles(t, width) for t in texts]
    for b in range(len(sets)):
        for a in range(b):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                yield a, b


def quality_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)
    )


def cycled_weights(sources):
    """Weights 1, 2, 3, repeating, by code point, null last."""
    return {s: 1 + n % 3 for n, s in enumerate(sorted(sources, key=lambda s: (s is None, s or "")))}


def targets(sizes, weights, total):
    """Words wanted of each source: by weight, held at three times what the source has."""
    out, free, left = {}, dict(weights), float(total)
    while free:
        share = left / sum(free.values())
        above = [s for s in free if share * free[s] > 3 * sizes[s]]
        if not above:
            return out | {s: share * w for s, w in free.items()}
        for s in above:
            out[s] = float(3 * sizes[s])
            left -= 3 * sizes[s]
            del free[s]
    return out


def luhn(digits):
    total = 0
    for n, c in enumerate(reversed(digits)):
        x = int(c) * (2 if n % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def _digits(text):
    return re.sub(r"[^0-9]", "", text)


PII = [
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda v: True),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda v: all(int(p) <= 255 for p in v.split("."))),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda v: 13 <= len(_digits(v)) <= 19 and luhn(_digits(v))),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda v: 9 <= len(_digits(v)) <= 15),
]


def pii_spans(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p, valid in PII for m in p.finditer(text or "") if valid(m[0])]


ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)


def secret_spans(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return [f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found)]


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*fields):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields])


def merkle_tree(digests):
    """All levels, from the leaves to the one node that remains."""
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][n : n + 16]) for n in range(0, len(levels[-1]), 16)])
    return levels


def merkle_path(levels, n):
    """Siblings to the left and to the right, level by level."""
    path = []
    for nodes in levels[:-1]:
        low = n // 16 * 16
        path.append((nodes[low:n], nodes[n + 1 : low + 16]))
        n //= 16
    return path


def manifest(rows):
    """Of rows (doc_id, source, lang, n_chars, text): doc_id, leaf, subroot, root, proof digest, folded root, verified."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        own = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees[s] = own, merkle_tree([leaf(*r) for r in own])
    top = merkle_tree([trees[s][1][-1][0] for s in order])
    out = []
    for place, s in enumerate(order):
        own, levels = trees[s]
        for n, row in enumerate(own):
            path = merkle_path(levels, n) + merkle_path(top, place)
            changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None
            found = leaf(*row[:4], lower_ascii(row[4])) if changed else leaf(*row)
            for left, right in path:
                found = sha(*left, found, *right)
            siblings = [x for left, right in path for x in left + right]
            out.append((row[0], leaf(*row), levels[-1][0], top[-1][0], sha(*siblings), found, found == top[-1][0]))
    return out


def vocabulary(rows):
    """Words of (doc_id, text) rows that are long and common enough, with their counts."""
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[a-zÀ-ÿ]+", lower_ascii(text or "")):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            k = h % len(run)
            counts[run[:k] + run[k + 1 :] if h % 97 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def spelling(rows):
    """Per word: word, form, root, n, n_near, form_n."""
    count = vocabulary(rows)
    near = {w: [x for x in count if one_edit(w, x)] for w in count}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-count[x], x), default=None)
        if best is not None and count[best] >= 2 * count[w]:
            form[w] = best
    out = []
    for w in count:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, count[w], len(near[w]), count.get(form.get(w))))
    return sorted(out)


def empty(df):
    return df.where(F.lit(False))
