"""Secret scans by assignment-aware lexing.

Texts that hold an assignment sign are lexed into names, literals and
operators of common source and configuration syntax (`name = "x"`, `name: x`,
`"name": "x"`, `export NAME=x`, `--name=x`, `d["name"] = "x"`, `name="x"` in
tags).  Literals joined by `+` or standing side by side form one value.  A
name that is assigned another name takes the literals that one was given,
before or after, so sensitivity flows along chains of constants.  A literal's score adds the
weight of the most sensitive name that reaches it to its own look (length,
variety, character classes), less what placeholders show; from `THRESHOLD` on
it is a finding of kind `literal`.

The base patterns are fixed by the contract and always reported.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import textbatch as tb
from strata.llm.common import bounded_batches

THRESHOLD = 4.0
KINDS = ("assign", "access", "hex", "literal")

# The base patterns of the contract.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")

# Weights of name parts; the heaviest that a name holds counts.
SENSITIVE = {
    "password": 3.0, "passwd": 3.0, "passphrase": 3.0, "pwd": 2.5, "secret": 3.0, "token": 2.5,
    "apikey": 3.0, "api_key": 3.0, "accesskey": 3.0, "access_key": 3.0, "privatekey": 3.0, "private_key": 3.0,
    "credential": 2.5, "credentials": 2.5, "auth": 2.0, "bearer": 2.5, "signing_key": 3.0,
    "encryption_key": 3.0, "client_secret": 3.0, "connection_string": 2.5, "dsn": 2.0,
}
# Names that speak of a secret without holding one.
_ABOUT = re.compile(r"(_|\b)(url|uri|path|file|name|id|type|length|len|count|policy|field|label|hint|prompt|ttl"
                    r"|expir\w*|endpoint|scope|bucket|table|header|format)$")
_PLACEHOLDER = re.compile(r"(?i)^(x+|\*+|\.+|change_?me|your.*|example.*|dummy|test|none|null|true|false|todo|"
                          r"placeholder|<.*>|\$\{.*\}|\$\(.*\)|\{\{.*\}\}|%\(.*\)s|\$[a-z_]\w*)$")

_LEX = re.compile(r"""
    (?P<quote>["'`])
  | (?P<name>-{0,2}[A-Za-z_][A-Za-z0-9_]*(?:[.-][A-Za-z_][A-Za-z0-9_]*)*)
  | (?P<op>:=|=>|->|==|!=|<=|>=|[=:+\[\](){},;<>])
  | (?P<line>\n)
  | (?P<other>[^\s"'`A-Za-z_=:+\[\](){},;<>\n]+)
""", re.VERBOSE)
_CLOSED = {'"': re.compile(r'"(?:[^"\\\n]|\\.)*+"'), "'": re.compile(r"'(?:[^'\\\n]|\\.)*+'"),
           "`": re.compile(r"`[^`\n]*+`")}
_BARE = re.compile(r"[^\s\"'`,;(){}\[\]<>]+")
_NEXT_PAIR = re.compile(r"[=&]")
_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_.]*")
_PREFIX = re.compile(r"(?i)(?<![A-Za-z0-9_])[bfru]{1,2}\Z")
_QUOTED_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_.-]*\Z")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    return out + [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]


# ------------------------------------------------------------------ lexing

def _tokens(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all tokens.  A quote opens a string unless it
    follows a word (as in "don't") that is no string prefix; one that does not
    close on its line is skipped, and so are the later ones of its kind there
    (each is escaped, so none of them closes either)."""
    out, at, closed_off = [], 0, {}
    while m := _LEX.search(text, at):
        kind, a, at = m.lastgroup, m.start(), m.end()
        if kind == "quote":
            q = text[a]
            if a < closed_off.get(q, 0) or (q != "`" and a and (text[a - 1].isalnum() or text[a - 1] == "_")
                                            and not _PREFIX.search(text, max(0, a - 3), a)):
                continue
            m = _CLOSED[q].match(text, a)
            if not m:
                end = text.find("\n", a)
                closed_off[q] = end if end >= 0 else len(text)
                continue
            kind, at = "string", m.end()
        out.append((kind, a, at))
    return out


def assignments(text: str):
    """(name, value) pairs in order; a value is ("lit", [(start, end), ...]),
    ("ref", name, (start, end)) or ("word", name, (start, end)): a word where a
    configuration file has its values, a literal if no such name is known."""
    toks = _tokens(text)
    n, run, taken = len(toks), (0, 0), 0
    for k, (kind, a, b) in enumerate(toks):
        name = None
        if kind == "name":
            name = text[a:b].lstrip("-")
        elif kind == "string" and _QUOTED_NAME.match(text, a + 1, b - 1):
            name = text[a + 1:b - 1]
        j = k + 1
        if name and j < n and toks[j][0] == "op" and text[toks[j][1]] == "]":
            j += 1  # d["name"] = ...
        if not name or j >= n or toks[j][0] != "op" or text[toks[j][1]:toks[j][2]] not in ("=", ":", ":=", "=>"):
            continue
        sign, after = toks[j], toks[j + 1] if j + 1 < n else ("line", 0, 0)
        prefixed = (after[0] == "name" and j + 2 < n and toks[j + 2][0] == "string"
                    and toks[j + 2][1] == after[2])  # r"..."
        if prefixed or after[0] not in ("name", "other"):
            value = _strings(text, toks, j + 1 + prefixed)
            if value:
                yield name, ("lit", value)
            continue
        start = after[1]
        if start >= run[1]:  # a run of value characters has one end, wherever it is entered
            m = _BARE.match(text, start)
            run = (start, m.end()) if m else (start, start)
        end = run[1]
        if start < taken:
            # within another value: pairs of a query string, not "host:port"
            if text[sign[1]:sign[2]] == ":":
                continue
            m = _NEXT_PAIR.search(text, start, end)
            end = m.start() if m else end
        else:
            taken = end
        while end > start and text[end - 1] in ".:":
            end -= 1
        if end == start:
            continue
        m = _IDENTIFIER.match(text, start, end) if after[0] == "name" else None
        if not m or m.end() < end or _mixed(text[start:end]):
            yield name, ("lit", [(start, end)])
        else:
            yield name, ("word" if _is_value(text, a, sign, start, end) else "ref", text[start:end], (start, end))


def _strings(text: str, toks: list, k: int) -> list[tuple[int, int]]:
    """The strings from token k on that stand side by side or are joined by +."""
    parts = []
    while k < len(toks):
        kind, a, b = toks[k]
        if kind == "string":
            if b - a > 2:
                parts.append((a + 1, b - 1))
        elif not (kind == "op" and parts and text[a:b] == "+"):
            break
        k += 1
    return parts


def _is_value(text: str, name_at: int, sign: tuple, start: int, end: int) -> bool:
    """Whether a bare word stands as `name=word` before a blank, or as
    `name: word` alone on its line, and is no name by its form."""
    word = text[start:end]
    if "_" in word or "." in word or name_weight(word) or not (end == len(text) or text[end] in " \t\r\n&;"):
        return False
    if text[sign[1]:sign[2]] == "=":
        return sign[2] == start and not text[sign[1] - 1].isspace()
    before, after = text[max(0, name_at - 64):name_at], text[end:end + 64]
    return (text[sign[1]:sign[2]] == ":" and before[before.rfind("\n") + 1:].strip(" \t-") == ""
            and after.split("\n", 1)[0].strip() == "")


def _mixed(word: str) -> bool:
    """Whether a bare word looks like a value rather than an identifier."""
    return len(word) >= 8 and any(c.isdigit() for c in word) and any(c.isalpha() for c in word)


# ----------------------------------------------------------------- scoring

def name_weight(name: str) -> float:
    snake = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name).lower().replace("-", "_").replace(".", "_")
    if _ABOUT.search(snake):
        return 0.0
    parts = "_" + snake + "_"
    return max((w for s, w in SENSITIVE.items() if f"_{s}_" in parts), default=0.0)


def look(value: str) -> float:
    """How much a literal looks like a secret by itself."""
    n = len(value)
    if n < 6 or _PLACEHOLDER.match(value) or any(c.isspace() for c in value):
        return -10.0
    counts = {}
    for c in value:
        counts[c] = counts.get(c, 0) + 1
    bits = -sum(v / n * math.log2(v / n) for v in counts.values())
    classes = sum((any(c.islower() for c in value), any(c.isupper() for c in value),
                   any(c.isdigit() for c in value), any(not c.isalnum() for c in value)))
    return (n >= 8) * 0.5 + (n >= 16) * 0.5 + (bits >= 3) * 0.5 + (bits >= 3.5) * 0.5 + 0.5 * (classes - 1)


def literal_spans(text: str) -> list[tuple[str, int, int]]:
    """Literals whose score reaches the threshold.

    A name stands for what it was given last before, or else first after; the
    chains are followed to their ends, whatever the order of the assignments.
    """
    pairs = list(assignments(text))
    last, first, to = {}, {}, []  # by the last part of a name: number of an assignment
    for i, (name, value) in enumerate(pairs):
        to.append(None if value[0] == "lit" else last.get(value[1].rsplit(".", 1)[-1], -1))
        short = name.rsplit(".", 1)[-1]
        last[short] = i
        first.setdefault(short, i)
    ends: dict[int, int] = {}
    for i in range(len(pairs)):
        path, k = [], i
        while k not in ends:
            path.append(k)
            ends[k] = k  # a ring ends where it is entered
            if to[k] is None:
                break
            k2 = to[k] if to[k] >= 0 else first.get(pairs[k][1][1].rsplit(".", 1)[-1], k)
            if k2 == k:
                break
            k = k2
        for j in path:
            ends[j] = ends[k]
    heaviest: dict[int, float] = {}  # of the names that an end reaches
    for i, (name, _) in enumerate(pairs):
        weight = name_weight(name)
        if weight:
            heaviest[ends[i]] = max(weight, heaviest.get(ends[i], 0.0))
    found = set()
    for k, weight in heaviest.items():
        kind, value = pairs[k][1][0], pairs[k][1][-1]
        if kind == "ref":
            continue
        value = value if kind == "lit" else [value]
        if weight + look("".join(text[a:b] for a, b in value)) >= THRESHOLD:
            found.update(value)
    return [("literal", a, b) for a, b in sorted(found)]


def spans(text: str, lex: bool = True) -> tuple[list, list]:
    """(base spans, all spans), each by start and kind; a literal inside a base
    span is that span's."""
    order = KINDS.index
    base = sorted(base_spans(text), key=lambda s: (s[1], order(s[0])))
    starts, furthest = [s[1] for s in base], list(accumulate((s[2] for s in base), max))
    more = []
    for s in literal_spans(text) if lex else ():
        k = bisect_right(starts, s[1])
        if not k or furthest[k - 1] < s[2]:
            more.append(s)
    return base, sorted(base + more, key=lambda s: (s[1], order(s[0]), s[2]))


# ---------------------------------------------------------------- operator

_IS_HEX = np.zeros(256, dtype=bool)
_IS_HEX[0x30:0x3A] = True
_IS_HEX[0x61:0x67] = True


def _suspects(t: tb.Texts) -> np.ndarray:
    """Texts with an assignment sign, a long hexadecimal run or "AKIA": all
    others can have no span."""
    sign = t.totals((t.data == ord("=")) | (t.data == ord(":"))) > 0
    stops = np.flatnonzero(~_IS_HEX[t.data])
    stops = np.concatenate(([-1], stops, [len(t.data)]))
    run = np.flatnonzero(np.diff(stops) > 32)
    hexes = np.zeros(t.n, dtype=bool)
    for a, b in zip(stops[run] + 1, stops[run + 1]):
        # a run may cross texts: all it touches are looked at
        i, j = np.searchsorted(t.offsets, (a, b - 1), "right")
        hexes[max(i - 1, 0):j] = True
    d = t.data
    akia = np.zeros(len(d), dtype=bool)
    if len(d) > 3:
        akia[:-3] = (d[:-3] == 0x41) & (d[1:-2] == 0x4B) & (d[2:-1] == 0x49) & (d[3:] == 0x41)
    return sign | hexes | (t.totals(akia) > 0)


def _scan(batches):
    for batch in batches:
        ids = batch.column(0)
        for i, j, t in tb.slices(batch, "text"):
            cols = {k: [""] * t.n for k in ("base", "all")}
            counts = np.zeros((3, t.n), dtype=np.int64)
            for k in np.flatnonzero(_suspects(t)):
                text = t.data[t.offsets[k]:t.offsets[k + 1]].tobytes().decode()
                base, every = spans(text)
                for s in base:
                    counts[KINDS.index(s[0]), k] += 1
                cols["base"][k] = ",".join(f"{x}:{a}:{b}" for x, a, b in base)
                cols["all"][k] = ",".join(f"{x}:{a}:{b}" for x, a, b in every)
            digest = [hashlib.sha256(x.encode()).hexdigest() for x in cols["base"]]
            yield pa.RecordBatch.from_arrays(
                [ids.slice(i, j - i), *[pa.array(c, pa.int64()) for c in counts],
                 pa.array(digest, pa.string()), pa.array(cols["all"], pa.string())],
                names=["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_assign, n_access, n_hex, base_sha256, spans), one row per
    input row; spans lists kind:start:end in code points, end exclusive.

    Null and empty texts have no span; very long ones are lexed whole, in time
    linear in their length.  Repeated rows are scanned row by row.
    An empty table gives no row.  Other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(_scan, f"id {kind}, n_assign long, n_access long, n_hex long, "
                                  "base_sha256 string, spans string").withColumnRenamed("id", id_col)
