"""SQL twins of the queries that SQL can express, for DuckDB over the same tables."""

SPLIT_WORDS = r"regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{pattern}')"

_BASE32 = "list_aggregate(list_transform(range(8), lambda g: list_aggregate(list_transform(range(4), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr({hex}, 1 + 5 * g, 5))::BIGINT >> (5 * (3 - k))) & 31)::INT, 1)), 'string_agg', '')), 'string_agg', '')"

OP2 = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS hex, min(page_id) OVER (PARTITION BY payload) AS first_id FROM p)
SELECT page_id, payload_bytes, {_BASE32.format(hex='hex')} AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM d"""

OP5 = r"""
WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM n JOIN g USING (text_sha256)"""

_WORDS = SPLIT_WORDS.format(text="coalesce(text, '')", pattern=r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
OP10 = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS gram
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS s FROM i WHERE len(w) > 0)),
lens AS (SELECT DISTINCT k FROM win),
grams AS (SELECT doc_id, s, k, array_to_string(w[s:s + k - 1], ' ') AS gram
          FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, lens WHERE len(w) >= k)),
hits AS (SELECT g.doc_id, g.s, g.k, win.item_id FROM grams g JOIN win USING (k, gram)),
cover AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + k)) AS pos FROM (SELECT DISTINCT doc_id, s, k FROM hits)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN items USING (doc_id)"""

OP8 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, {SPLIT_WORDS.format(text="coalesce(text, '')", pattern=r"[^\x20\x09-\x0D]+")} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS gram
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b USING (gram) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, w.b FROM reach r JOIN ways w ON w.a = r.b),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN least USING (doc_id)"""

ORACLES = {"op8_near_dup": OP8, "op2_warc": OP2, "op5_exact_dedup": OP5, "op10_decontaminate": OP10}

#: CRC-32 of a short string, bit by bit: DuckDB has no function for it.
_CRC32 = ("xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length({text}) + 1), lambda k: ascii(substr({text}, k::INT, 1))::BIGINT)), "
          "lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)")


def _field(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR) || ':' || {column}::VARCHAR, '-')"


def _levels(name: str, leaves: str, fanout: int = 8) -> str:
    """All nodes of the trees over `leaves` (key, pos, n, h), and the groups of children: key, lvl, parent, n of the parent's level, digests."""
    return f"""
{name} AS (SELECT key, 0 AS lvl, pos, n, h FROM {leaves}
 UNION ALL SELECT key, lvl + 1, pos // {fanout}, (n + {fanout - 1}) // {fanout}, sha256(string_agg(h, '' ORDER BY pos)) FROM {name} WHERE n > 1 GROUP BY key, lvl, pos // {fanout}, n),
{name}_runs AS (SELECT key, lvl, pos // {fanout} AS parent, list(h ORDER BY pos) AS hs FROM {name} WHERE n > 1 GROUP BY key, lvl, pos // {fanout})"""


def _climb(name: str, start: str, tree: str, fanout: int = 8) -> str:
    """Each row of `start` (row_no, key, pos, received, proof) folded to the root of its tree."""
    return f"""
{name} AS (SELECT row_no, key, 0 AS lvl, pos, received, proof FROM {start}
 UNION ALL SELECT c.row_no, c.key, c.lvl + 1, c.pos // {fanout},
  sha256(array_to_string(r.hs[:c.pos % {fanout}], '') || c.received || array_to_string(r.hs[c.pos % {fanout} + 2:], '')),
  c.proof || array_to_string(r.hs[:c.pos % {fanout}], '') || array_to_string(r.hs[c.pos % {fanout} + 2:], '')
  FROM {name} c JOIN {tree}_runs r ON r.key = c.key AND r.lvl = c.lvl AND r.parent = c.pos // {fanout}),
{name}_end AS (SELECT row_no, arg_max(received, lvl) AS received, arg_max(proof, lvl) AS proof FROM {name} GROUP BY row_no)"""


_LEAF_FIELDS = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP11 = f"""
WITH RECURSIVE raw AS (SELECT row_number() OVER () AS row_no, doc_id, coalesce('=' || lang, '') AS key, sha256({_LEAF_FIELDS} || {_field('text')}) AS h,
  CASE WHEN {_CRC32.format(text='doc_id::VARCHAR')} % 3 = 0 THEN sha256({_LEAF_FIELDS} || {_field(_LOWER)}) END AS changed FROM documents),
leaves AS (SELECT row_no, doc_id, key, h, coalesce(changed, h) AS received, count(*) OVER (PARTITION BY key) AS n,
  row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, h, row_no) - 1 AS pos FROM raw),
{_levels('nodes', 'leaves')},
subs AS (SELECT key AS lang_key, h AS subroot, 0 AS key, row_number() OVER (ORDER BY key) - 1 AS pos, count(*) OVER () AS n, h FROM nodes WHERE n = 1),
{_levels('tops', 'subs')},
{_climb('low', "(SELECT *, '' AS proof FROM leaves)", 'nodes')},
half AS (SELECT l.row_no, s.key, s.pos, e.received, e.proof FROM leaves l JOIN low_end e USING (row_no) JOIN subs s ON s.lang_key = l.key),
{_climb('high', 'half', 'tops')}
SELECT l.doc_id, l.h AS leaf, s.subroot, t.h AS root, sha256(e.proof) AS proof_sha256, e.received AS folded_root, e.received = t.h AS verified
FROM leaves l JOIN subs s ON s.lang_key = l.key JOIN high_end e USING (row_no), (SELECT h FROM tops WHERE n = 1) t"""

OP13 = r"""
WITH d AS (SELECT doc_id, coalesce('0' || source, '1') AS key, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT key, sum(size)::BIGINT AS source_size, [5, 2, 1][((row_number() OVER (ORDER BY key) - 1) % 3 + 1)::INT]::DOUBLE AS w FROM d GROUP BY key),
f AS (SELECT *, coalesce(sum(3 * source_size) OVER before, 0) AS given, coalesce(sum(w) OVER before, 0) AS closed FROM s
      WINDOW before AS (ORDER BY 3 * source_size / w, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
e AS (SELECT *, ((SELECT sum(size) FROM d) - given)::DOUBLE / ((SELECT sum(w) FROM s) - closed) AS each FROM f),
level AS (SELECT max(each) AS each FROM e),
t AS (SELECT key, source_size, CASE WHEN 3 * source_size > w * level.each THEN w * level.each ELSE 3.0::DOUBLE * source_size END AS target FROM e, level),
o AS (SELECT doc_id, size, source_size, target, sum(size) OVER (PARTITION BY key ORDER BY md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')), doc_id, size
             ROWS UNBOUNDED PRECEDING) - size AS start, key FROM d JOIN t USING (key)),
c AS (SELECT *, least(size, floor(target)::BIGINT - start - turn * source_size) AS words, (turn * source_size + start + size)::DOUBLE / target AS finish
      FROM (SELECT *, unnest([0, 1, 2]) AS turn FROM o WHERE size > 0)),
m AS (SELECT *, sum(words) OVER (ORDER BY finish, key, doc_id, turn ROWS UNBOUNDED PRECEDING) - words AS place FROM c WHERE words > 0),
g AS (SELECT doc_id, sum(words)::BIGINT AS taken, min(place)::BIGINT AS first_word FROM m GROUP BY doc_id)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken, first_word FROM o LEFT JOIN g USING (doc_id)"""

ORACLES |= {"op11_merkle": OP11, "op13_mixing": OP13}
