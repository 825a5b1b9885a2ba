"""DuckDB SQL for the operators that SQL can express, with its own values."""

CHAT = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), k AS (
  SELECT *, len(regexp_extract_all(text, '[A-Za-z0-9_]+|[^A-Za-z0-9_\x20\x09-\x0D]')) + 4 AS tokens,
    length(text) + length(regexp_replace(text, '[^\\<\[\]]', '', 'g'))
      + length(role) + length(regexp_replace(role, '[^\\<\[\]]', '', 'g')) + 11 AS chars
  FROM t
), p AS (
  SELECT *, row_number() OVER w AS pos, sum(tokens) OVER w AS after FROM k
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)
), b AS (
  SELECT *, after - tokens AS before, floor((after - tokens) / 768) AS bucket,
    floor((after - 1) / 768) > floor((after - tokens) / 768) AS crosses FROM p
), g AS (
  SELECT *, 2 * bucket + crosses::INT AS key FROM b
), w AS (
  SELECT conv_id, key, min(before) AS start, sum(chars) AS chars,
    lag(key) OVER (PARTITION BY conv_id ORDER BY key) AS previous FROM g GROUP BY conv_id, key
), s AS (
  SELECT conv_id, min(pos) AS pos, arg_min(key, pos) AS key, arg_min(chars, pos) AS chars
  FROM g WHERE role = 'system' GROUP BY conv_id
), f AS (
  SELECT w.conv_id, w.key, w.chars
    + coalesce((SELECT s.chars FROM s WHERE s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.key < w.key), 0)
    + coalesce((SELECT sum(g.chars) FROM g LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM g.conv_id
        WHERE g.conv_id IS NOT DISTINCT FROM w.conv_id AND g.key = w.previous AND w.start - g.before <= 256
          AND (s.pos IS NULL OR s.pos <> g.pos)), 0) AS chars
  FROM w
), c AS (
  SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
    coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '') AS loss
  FROM p GROUP BY conv_id
)
SELECT c.conv_id, c.n_turns::BIGINT AS n_turns, c.turns_sha256, length(c.loss)::BIGINT AS loss_chars,
  sha256(c.loss) AS loss_sha256,
  (SELECT sum(f.chars) FROM f WHERE f.conv_id IS NOT DISTINCT FROM c.conv_id)::BIGINT AS formatted_chars
FROM c
"""

MIXING = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n FROM documents
), s AS (
  SELECT source, sum(n)::BIGINT AS tokens FROM d GROUP BY source
), l AS (
  SELECT list(ln(tokens / (SELECT sum(tokens) FROM s))) AS lp FROM s WHERE tokens > 0
), m AS (
  SELECT 0 AS i, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi
  UNION ALL
  SELECT i + 1, CASE WHEN ok THEN mid ELSE lo END, CASE WHEN ok THEN hi ELSE mid END FROM (
    SELECT i, lo, hi, mid, ln(z) - wl / z >= 0.97 * ln(n) - 1e-12 OR most / z > 4.0 AS ok FROM (
      SELECT i, lo, hi, (lo + hi) / 2 AS mid, len(lp) AS n,
        list_sum(list_transform(lp, lambda x: exp((lo + hi) / 2 * x))) AS z,
        list_sum(list_transform(lp, lambda x: exp((lo + hi) / 2 * x) * (lo + hi) / 2 * x)) AS wl,
        list_max(list_transform(lp, lambda x: exp((lo + hi) / 2 * x) / exp(x))) AS most
      FROM m, l WHERE i < 30 AND len(lp) > 0))
), a AS (
  SELECT round((lo + hi) / 2, 6) AS a FROM m ORDER BY i DESC LIMIT 1
), q AS (
  SELECT source, tokens, CASE WHEN tokens > 0 THEN
      round(pow(tokens::DOUBLE, a) / (SELECT sum(pow(tokens::DOUBLE, a)) FROM s, a WHERE tokens > 0)
            * (SELECT sum(tokens) FROM s))::BIGINT ELSE 0 END AS quota,
    ceil(greatest(tokens, 1) / 1000000)::BIGINT AS blocks FROM s, a
), e AS (
  SELECT *, quota // greatest(tokens, 1) AS epochs, quota % greatest(tokens, 1) AS rest FROM q
), x AS (
  SELECT d.*, e.epochs, e.rest, coalesce(d.doc_id::VARCHAR, 'null') AS id,
    coalesce('=' || d.source, 'null') AS skey,
    ('0x' || substr(md5('mix:' || coalesce(d.doc_id::VARCHAR, 'null')), 1, 15))::BIGINT % e.blocks AS block
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source
), y AS (
  SELECT source, skey, block, epochs, rest, sum(n) AS t FROM x GROUP BY ALL
), z AS (
  SELECT *, sum(t) OVER (PARTITION BY source ORDER BY
    ('0x' || substr(md5('mix-block:' || epochs || ':' || skey || ':' || block), 1, 15))::BIGINT, block
    ROWS UNBOUNDED PRECEDING) AS after FROM y
), u AS (
  SELECT x.*, z.after, z.t, sum(x.n) OVER (PARTITION BY x.source, x.block ORDER BY
    ('0x' || substr(md5('mix-doc:' || x.epochs || ':' || x.id), 1, 15))::BIGINT, x.doc_id, x.n
    ROWS UNBOUNDED PRECEDING) AS upto
  FROM x JOIN z ON x.source IS NOT DISTINCT FROM z.source AND x.block = z.block
), v AS (
  SELECT *, epochs + CASE WHEN after <= rest THEN 1
    WHEN after - t < rest AND upto <= rest - (after - t) THEN 1 ELSE 0 END AS copies FROM u
)
SELECT doc_id, source, n AS n_tokens, epoch::BIGINT AS epoch,
  ('0x' || substr(md5('mix-block:' || epoch || ':' || skey || ':' || block), 1, 15))::BIGINT AS block_order
FROM (SELECT *, unnest(range(copies::BIGINT)) AS epoch FROM v)
"""

JACCARD = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n, md5(string_agg(g, chr(10) ORDER BY g)) AS sid FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
), l AS (
  SELECT x, y, nx.sid AS sx, ny.sid AS sy FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
  WHERE 5 * c >= 4 * (nx.n + ny.n - c)
), r AS (
  SELECT doc_id, doc_id AS root FROM n UNION SELECT l.y, r.root FROM r JOIN l ON l.x = r.doc_id
), c AS (
  SELECT doc_id, min(root) AS class_id, count(*) AS class_docs FROM r GROUP BY doc_id
), k AS (
  SELECT x, count(*) AS n_links, count(DISTINCT CASE WHEN sx <> sy THEN sy END) AS n_set_links FROM l GROUP BY x
)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS set_size, coalesce(c.class_id, w.doc_id) AS class_id,
  coalesce(c.class_docs, 1)::BIGINT AS class_docs, coalesce(k.n_links, 0)::BIGINT AS n_links,
  coalesce(k.n_set_links, 0)::BIGINT AS n_set_links
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id) LEFT JOIN k ON k.x = w.doc_id
"""

LINES = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS s,
    generate_subscripts(string_split(text, chr(10)), 1) AS line FROM documents
), w AS (
  SELECT *, regexp_extract_all(s, '[^\x20\x09-\x0D]+') AS w FROM l
), e AS (
  SELECT *, CASE WHEN len(w) >= 1 THEN array_to_string(w, ' ') END AS k, doc_id * 1000000 + line AS rank FROM w
), f AS (
  SELECT k, min(rank) AS rank, any_value(w) AS w FROM e WHERE k IS NOT NULL GROUP BY k
), v AS (
  SELECT k, rank, -1 AS p, k AS v FROM f WHERE len(w) >= 10
  UNION ALL
  SELECT k, rank, p, array_to_string(list_concat(w[1:p], w[p + 2:]), ' ')
  FROM (SELECT *, unnest(range(len(w))) AS p FROM f WHERE len(w) >= 10)
), near AS (
  SELECT DISTINCT a.k FROM v a JOIN v b ON a.v = b.v AND b.rank < a.rank AND (a.p = b.p OR a.p = -1 OR b.p = -1)
), g AS (
  SELECT e.doc_id, e.line, e.s, f.rank = e.rank AS is_first, near.k IS NOT NULL AS near,
    e.k IS NOT NULL AND (f.rank <> e.rank OR near.k IS NOT NULL) AS gone
  FROM e LEFT JOIN f ON f.k = e.k LEFT JOIN near ON near.k = e.k
), d AS (
  SELECT doc_id, count(*) FILTER (gone) AS gone, count(*) FILTER (near AND is_first) AS near,
    coalesce(string_agg(s, chr(10) ORDER BY line) FILTER (NOT gone), '') AS text FROM g GROUP BY doc_id
)
SELECT o.doc_id, coalesce(d.gone, 0)::BIGINT AS n_lines_removed, coalesce(d.near, 0)::BIGINT AS n_near_removed,
  CASE WHEN o.text IS NOT NULL THEN d.text END AS text
FROM documents o LEFT JOIN d ON d.doc_id = o.doc_id
"""

# Unit words and symbols.
UNITS = ("mm cm m km in ft yd mi mile miles meter meters metre metres mg g kg lb lbs oz gram grams ton tons "
         "ml l liter liters litre litres gal gallon gallons s sec second seconds min minute minutes h hr hour "
         "hours day days week weeks month months year years % percent dollar dollars euro euros cent cents "
         "pound pounds usd eur gbp mph kmh km/h kwh kw w v hz khz mhz ghz kb mb gb tb").split()

# Windows of eight words; the benchmark's items have at least as many.
TEMPLATES = r"""
WITH t AS (
  SELECT 'd' AS src, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark
), l AS (
  SELECT src, id, unnest(string_split(text, chr(10))) AS s,
    generate_subscripts(string_split(text, chr(10)), 1) AS ln FROM t
), w AS (
  SELECT src, id, ln, unnest(regexp_extract_all(s, '[^\x20\x09-\x0D]+')) AS w,
    generate_subscripts(regexp_extract_all(s, '[^\x20\x09-\x0D]+'), 1) AS i FROM l
), o AS (
  SELECT *, lag(w) OVER (PARTITION BY src, id, ln ORDER BY i) AS before,
    regexp_replace(w, '^[!-$&-/:-@\[-`{-~]+|[!-$&-/:-@\[-`{-~]+$', '', 'g') AS core FROM w
), k AS (
  SELECT src, id, lower(core) AS v,
    before IS NOT NULL AND NOT regexp_matches(before, '[!-$&-/:-@\[-`{-~]$')
    AND NOT regexp_matches(w, '^[!-$&-/:-@\[-`{-~]') AS touch, row_number() OVER (PARTITION BY src, id ORDER BY ln, i) AS pos,
    CASE WHEN regexp_matches(core, '[0-9]') THEN 1 WHEN lower(core) IN (@UNITS) THEN 3
      WHEN regexp_matches(core, '^[A-ZÀ-ÖØ-Þ]') AND before IS NOT NULL AND NOT regexp_matches(before, '[.!?:;]$')
      THEN 2 ELSE 0 END AS kind, regexp_matches(core, '^[A-ZÀ-ÖØ-Þ]') AS upper
  FROM o WHERE core <> ''
), r AS (
  SELECT src, id, v, pos, kind, touch, false AS quoted FROM k
  UNION ALL
  SELECT src, id, v, pos, CASE WHEN pos = 1 THEN 2 ELSE kind END, touch, true
  FROM k WHERE src = 'b' AND id IN (SELECT id FROM k WHERE src = 'b' AND pos = 1 AND upper AND kind = 0)
), j AS (
  SELECT *, touch AND kind = 2 AND coalesce(lag(kind) OVER z = 2, false) AS joined
  FROM r WINDOW z AS (PARTITION BY src, id, quoted ORDER BY pos)
), u AS (
  SELECT *, count(*) FILTER (NOT joined) OVER (PARTITION BY src, id, quoted ORDER BY pos) AS place FROM j
), e AS (
  SELECT src, id, quoted, place AS pos, any_value(kind) AS kind, string_agg(v, ' ' ORDER BY pos) AS v
  FROM u GROUP BY src, id, quoted, place
), x AS (
  SELECT src, id, pos, quoted, count(*) OVER z AS n, count(*) FILTER (kind = 0) OVER z AS literals,
    list(CASE kind WHEN 0 THEN v ELSE '<' || kind || '>' END) OVER z AS h,
    list(CASE WHEN kind <> 0 THEN v END) OVER z AS slots
  FROM e WINDOW z AS (PARTITION BY src, id, quoted ORDER BY pos ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)
), y AS (
  SELECT src, id, pos, array_to_string(h, ' ') AS h, list_filter(slots, lambda s: s IS NOT NULL) AS slots
  FROM x WHERE n = 8 AND literals >= 5 AND (NOT quoted OR pos = 1)
), m AS (
  SELECT d.id AS doc, b.id AS item, d.pos - b.pos AS shift, b.pos, b.slots AS a, d.slots AS c
  FROM y d JOIN y b ON d.h = b.h AND d.src = 'd' AND b.src = 'b'
), g AS (
  SELECT doc, item, shift, list(DISTINCT pos) AS pos, list(DISTINCT pos) FILTER (len(a) = 0) AS plain,
    list_distinct(flatten(list(list_zip(a, c)))) AS map FROM m GROUP BY doc, item, shift
), q AS (
  SELECT *, len(list_distinct(list_transform(map, lambda p: p[1]))) = len(map) AS fits FROM g
), f AS (
  SELECT doc, item, len(list_distinct(flatten(list(CASE WHEN fits THEN pos ELSE coalesce(plain, []) END)))) AS found,
    min(CASE WHEN fits THEN len(list_filter(map, lambda p: p[1] <> p[2])) ELSE 0 END) AS changed
  FROM q GROUP BY doc, item
), n AS (
  SELECT id AS item, count(DISTINCT pos) AS windows FROM y WHERE src = 'b' GROUP BY id
)
SELECT doc AS doc_id, item AS item_id, windows::BIGINT AS item_windows, found::BIGINT AS found,
  changed::BIGINT AS changed_slots
FROM f JOIN n USING (item) WHERE found > 0 AND found >= 0.5 * windows
""".replace("@UNITS", ", ".join(f"'{u}'" for u in UNITS))


# crc32 (reversed polynomial 0xEDB88320) as a lookup list, and over a list of bytes
_CRC_TABLE = """crc AS MATERIALIZED (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: xor(a >> 1, 3988292384 * (a & 1))) ORDER BY i) AS t
  FROM range(256) AS r(i)
)"""
_CRC = ("xor(list_reduce(list_prepend(4294967295, {bytes}), lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8)), "
        "4294967295)")
_BYTES = ("list_transform(range(0, strlen({word})), lambda i: "
          "16 * (instr('0123456789ABCDEF', substr(hex(encode({word})), (2 * i + 1)::INTEGER, 1)) - 1) + "
          "instr('0123456789ABCDEF', substr(hex(encode({word})), (2 * i + 2)::INTEGER, 1)) - 1)")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _crc32(word: str) -> str:
    return _CRC.format(bytes=_BYTES.format(word=word))


def _runs(name: str, below: str, key: str) -> str:
    """Nodes of the next level: the text of each run of 16 and its digest."""
    return f"""{name} AS MATERIALIZED (
  SELECT {key}, pos // 16 AS pos, string_agg(d, '' ORDER BY pos) AS run, sha256(string_agg(d, '' ORDER BY pos)) AS d,
         (any_value(n) + 15) // 16 AS n
  FROM {below} WHERE n > 1 GROUP BY ALL
)"""


def _merkle(levels: int = 5, upper: int = 3) -> str:
    """Trees of up to 16^levels rows a source and 16^upper sources."""
    field = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"
    leaf = lambda text: "sha256(" + " || ".join(map(field, ["doc_id", "source", "lang", "n_chars", text])) + ")"
    ctes = [_CRC_TABLE, f"""leaves AS MATERIALIZED (
  SELECT doc_id, source, {leaf("text")} AS d, CASE WHEN {_crc32("doc_id::VARCHAR")} % 5 = 0
         THEN {leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} ELSE {leaf("text")} END AS shown
  FROM documents, crc
)""", """s0 AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, d) - 1 AS pos,
         count(*) OVER (PARTITION BY source) AS n FROM leaves
)"""]
    ctes += [_runs(f"s{k}", f"s{k - 1}", "source") for k in range(1, levels + 1)]
    tops = " UNION ALL ".join(f"SELECT source, d FROM s{k} WHERE n = 1" for k in range(levels + 1))
    ctes.append(f"""u0 AS MATERIALIZED (
  SELECT source, d, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM ({tops})
)""")
    ctes += [_runs(f"u{k}", f"u{k - 1}", "0 AS whole") for k in range(1, upper + 1)]
    root = " UNION ALL ".join(f"SELECT d FROM u{k} WHERE n = 1" for k in range(upper + 1))

    def path(table: str, first: str, match: str, height: int, proof: str, folded: str, name: str) -> list[str]:
        steps = []
        for k in range(1, height + 1):
            last = first if k == 1 else f"{name}{k - 1}"
            at = f"64 * ((p.leaf_at // {16 ** (k - 1)}) % 16)"
            steps.append(f"""{name}{k} AS MATERIALIZED (
  SELECT p.* REPLACE (
    {proof} || CASE WHEN t.run IS NULL THEN '' ELSE left(t.run, {at}) || substr(t.run, {at} + 65) END AS proof,
    CASE WHEN t.run IS NULL THEN {folded} ELSE sha256(left(t.run, {at}) || {folded} || substr(t.run, {at} + 65)) END
      AS folded)
  FROM {last} p LEFT JOIN {table}{k} t ON {match} AND t.pos = p.leaf_at // {16 ** k}
)""")
        return steps

    ctes.append("a0 AS MATERIALIZED (SELECT doc_id, source, d AS leaf, pos AS leaf_at, '' AS proof, shown AS folded FROM s0)")
    ctes += path("s", "a0", "t.source IS NOT DISTINCT FROM p.source", levels, "p.proof", "p.folded", "a")
    ctes.append(f"""b0 AS MATERIALIZED (
  SELECT a.* REPLACE (u.pos AS leaf_at), u.d AS subroot FROM a{levels} a JOIN u0 u ON u.source IS NOT DISTINCT FROM a.source
)""")
    ctes += path("u", "b0", "true", upper, "p.proof", "p.folded", "b")
    return "WITH " + ",\n".join(ctes) + f"""
SELECT b.doc_id, b.leaf, b.subroot, r.d AS root, sha256(b.proof) AS proof_sha256, b.folded AS folded_root,
       b.folded = r.d AS verified
FROM b{upper} b, ({root}) r"""


MERKLE = _merkle()

RESAMPLING = f"""
WITH {_CRC_TABLE},
words AS MATERIALIZED (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'),
                                           '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word FROM documents
),
wanted AS MATERIALIZED (
  SELECT unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'),
                                   '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word FROM benchmark
),
coded AS MATERIALIZED (
  SELECT word, {_crc32("word")} % 10000 AS bucket
  FROM (SELECT word FROM words UNION SELECT word FROM wanted), crc
),
have AS (SELECT bucket, count(*) AS s FROM words JOIN coded USING (word) GROUP BY 1),
want AS (SELECT bucket, count(*) AS t FROM wanted JOIN coded USING (word) GROUP BY 1),
gain AS MATERIALIZED (
  SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * (all_s + 10000)) /
                                 ((coalesce(s, 0) + 1)::DOUBLE * (all_t + 10000))))::BIGINT AS g
  FROM (SELECT DISTINCT bucket FROM coded) LEFT JOIN have USING (bucket) LEFT JOIN want USING (bucket),
       (SELECT count(*) AS all_s FROM words), (SELECT count(*) AS all_t FROM wanted)
),
weights AS (
  SELECT doc_id, count(*) AS n, sum(g)::BIGINT AS total
  FROM words JOIN coded USING (word) JOIN gain USING (bucket) GROUP BY 1
),
scored AS (
  SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM (SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_features,
               coalesce(total // n - CASE WHEN total % n < 0 THEN 1 ELSE 0 END, 0)::BIGINT AS weight,
               ('0x' || left(sha256('2024:' || d.doc_id), 8))::BIGINT AS h
        FROM documents d LEFT JOIN weights w ON w.doc_id = d.doc_id)
),
placed AS (
  SELECT *, n_features >= 20 AS fits, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS r,
         count_if(n_features >= 20) OVER () AS n
  FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN fits AND r <= 10 * n // 100 THEN r END AS rank FROM placed
"""
