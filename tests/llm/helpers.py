"""Brute-force versions of the operators, and odd inputs."""

import hashlib
import re
from collections import defaultdict

BLANK = re.compile(r"[^\x20\x09-\x0D]+")
DOC = "doc_id long, text string, lang string, source string, n_chars long"
# columns whose names an operator might use itself
CLASH = ("id long, mark long, h long, v string, grp string, kept string, n_words string, tokens string, "
         "copies long, set_id string, row string, found string, n_lines_removed long, spans string")


def docs(spark, rows, extra=True):
    """Documents from (doc_id, text[, lang, source]) with clashing columns."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s0",
             None if r[1] is None else len(r[1])) for r in rows]
    df = spark.createDataFrame(full, DOC)
    if extra:
        from pyspark.sql import functions as F
        for part in CLASH.split(", "):
            name, kind = part.split()
            df = df.withColumn(name, F.lit("7").cast(kind))
    return df


def words(text):
    return BLANK.findall(text or "")


def shingles(text, size=5):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1)))


def jaccard_classes(rows, threshold=0.8):
    """Per row index: (class id, rows in class, linked rows, linked sets)."""
    sets = [shingles(t) for _, t in rows]
    by = defaultdict(list)
    for k, s in enumerate(sets):
        if s:
            by[s].append(k)
    reps = list(by)
    root = list(range(len(reps)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    linked, distinct = [0] * len(reps), [0] * len(reps)
    for a in range(len(reps)):
        for b in range(a):
            both = len(reps[a] & reps[b])
            if both and both >= threshold * (len(reps[a]) + len(reps[b]) - both) - 1e-12:
                linked[a] += len(by[reps[b]])
                linked[b] += len(by[reps[a]])
                distinct[a] += 1
                distinct[b] += 1
                root[max(find(a), find(b))] = min(find(a), find(b))
    members = defaultdict(list)
    for k, s in enumerate(reps):
        members[find(k)] += by[s]
    out = {}
    for k, s in enumerate(reps):
        own = members[find(k)]
        low = min(rows[i][0] for i in own)
        for i in by[s]:
            out[i] = (low, len(own), len(by[s]) - 1 + linked[k], distinct[k])
    for i, s in enumerate(sets):
        if not s:
            out[i] = (rows[i][0], 1, 0, 0)
    return out


def base_counts(text):
    t = text or ""
    w = words(t)
    lines = [x for x in t.split("\n") if BLANK.search(x)]
    at = defaultdict(list)
    for k in range(len(w) - 2):
        at[tuple(w[k:k + 3])].append(k)
    repeated = {k + i for ks in at.values() if len(ks) > 1 for k in ks for i in range(3)}
    return (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(repeated))


def within_one(x, y):
    if len(x) > len(y):
        x, y = y, x
    if len(y) - len(x) > 1:
        return False
    k = 0
    while k < len(x) and x[k] == y[k]:
        k += 1
    return x[k + 1:] == y[k + 1:] if len(x) == len(y) else x[k:] == y[k + 1:]


def dedup_lines(rows, min_words=1, near_words=10):
    """{doc_id: text} with duplicate lines cut (distinct ids)."""
    first = {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        for k, line in enumerate((t or "").split("\n")):
            w = tuple(words(line))
            if len(w) >= min_words:
                first.setdefault(w, (i, k))
    near = {w for w, p in first.items() if len(w) >= near_words and any(
        q < p and len(v) >= near_words and abs(len(v) - len(w)) < 2 and within_one(v, w) for v, q in first.items())}
    out = {}
    for i, t in rows:
        out[i] = None if t is None else "\n".join(
            line for k, line in enumerate(t.split("\n"))
            if len(words(line)) < min_words or (first[tuple(words(line))] == (i, k) and tuple(words(line)) not in near))
    return out


def secret_base(text):
    t, out = text or "", []
    name = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
    for m in re.finditer(name + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, m.end()))
    for k, p, n in ((1, r"AKIA[A-Z0-9]+", 16), (2, r"[0-9a-f]+", 32)):
        out += [(m.start(), k, m.end()) for m in re.finditer(p, t) if m.end() - m.start() >= n]
    return sorted(out)


def pii_base(text):
    t, out = text or "", []
    out += [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m[0] if c in "0123456789"][::-1]
        if 12 <= len(d) <= 19 and sum(x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(d)) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def digest(spans, kinds):
    return hashlib.sha256(",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in spans).encode()).hexdigest()
