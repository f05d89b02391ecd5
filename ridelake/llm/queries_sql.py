"""The registered queries of the operators in SQL for DuckDB, where SQL can express them."""

# The words of a text and the white space around a line.
_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"
_BLANKS = r"chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _draw(identity: str) -> str:
    """A number from 0 up to 1 by hash."""
    return f"CAST('0x' || substr(md5('0:' || {identity}), 1, 13) AS BIGINT) / 4503599627370496.0"


def _level(k: int) -> str:
    """The documents of a level, taken where the running sum of the chance passes a whole number; the next level makes up for what they miss."""
    return f"""drawn_{k} AS (
  SELECT placed.*, chance, floor(start + place * chance) > floor(start + (place - 1) * chance) AS passed
  FROM placed JOIN state_{k - 1} s ON placed.source IS NOT DISTINCT FROM s.source WHERE level = {k}),
sums_{k} AS (
  SELECT source, sum(size) AS words, max(size) AS longest, sum(CASE WHEN passed THEN size ELSE 0 END) AS got FROM drawn_{k} GROUP BY source),
state_{k} AS (
  SELECT s.source, CASE WHEN words IS NULL THEN room ELSE room / 2 END AS room, others - coalesce(words, 0) AS others,
         chance - CASE WHEN others - words > 0 THEN least(CAST(1 AS DOUBLE), room / 2 * (others - words) / longest)
                            * ((got - chance * words) / (others - words)) ELSE 0 END AS chance
  FROM state_{k - 1} s LEFT JOIN sums_{k} ON s.source IS NOT DISTINCT FROM sums_{k}.source),
"""


OP6 = f"""
WITH sized AS (SELECT doc_id, text, source, {_WORDS} AS size FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 AS turn
  FROM sized GROUP BY source),
weighted AS (
  SELECT source, source_size, CASE turn WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM sources),
levels AS (
  SELECT DISTINCT 3.0 * source_size / weight AS level FROM weighted),
-- Words that all sources take when the shared level is at one source's limit.
taken AS (
  SELECT level, (SELECT sum(least(CAST(level * weight AS DOUBLE), 3.0 * source_size)) FROM weighted) AS words FROM levels),
-- The sources whose limit lies under the level that takes all words.
under AS (
  SELECT coalesce(max(level), -1) AS level FROM taken WHERE words < (SELECT sum(source_size) FROM weighted) - 1e-6),
rest AS (
  SELECT (SELECT sum(source_size) FROM weighted) AS words,
         (SELECT coalesce(sum(3 * source_size), 0) FROM weighted, under WHERE 3.0 * source_size / weight <= under.level) AS fixed,
         (SELECT sum(weight) FROM weighted, under WHERE 3.0 * source_size / weight > under.level) AS weights),
targets AS (
  SELECT source, source_size,
         CASE WHEN 3.0 * source_size / weight <= (SELECT level FROM under) THEN CAST(3 * source_size AS DOUBLE)
              ELSE least(CAST(words - fixed AS DOUBLE) / weights * weight, CAST(3 * source_size AS DOUBLE)) END AS target
  FROM weighted, rest),
rated AS (
  SELECT doc_id, sized.source, size, source_size, target, floor(rate) AS whole, rate - floor(rate) AS fraction,
         CASE WHEN size = 0 THEN NULL {" ".join(f"WHEN size * {8**k} >= source_size THEN {k}" for k in range(1, 5))} END AS level,
         {_draw("coalesce(CAST(doc_id AS VARCHAR), 'text:' || md5(text), '')")} AS draw
  FROM sized JOIN (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM targets) t
    ON sized.source IS NOT DISTINCT FROM t.source),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source, level ORDER BY size DESC, draw, CAST(doc_id AS VARCHAR)) AS place,
         {_draw("concat_ws(':', 'source', level, source)")} AS start FROM rated),
state_0 AS (
  SELECT source, any_value(fraction) AS chance, any_value(least(fraction, 1 - fraction)) AS room, any_value(source_size) AS others
  FROM rated GROUP BY source),
{"".join(_level(k) for k in range(1, 5))}
passed AS ({" UNION ALL ".join(f"SELECT doc_id, source, size, source_size, target, whole, passed AS more FROM drawn_{k}" for k in range(1, 5))}
  UNION ALL SELECT doc_id, placed.source, size, source_size, target, whole, draw < chance
  FROM placed JOIN state_4 ON placed.source IS NOT DISTINCT FROM state_4.source WHERE level IS NULL)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(size * (whole + CAST(more AS INT)) AS BIGINT) AS taken FROM passed
"""

OP10 = f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
split AS (SELECT row, doc_id, string_split(text, chr(10)) AS lines FROM docs),
lines AS (
  SELECT row, i, lines[i] AS line, trim({_LOWER.format('lines[i]')}, {_BLANKS}) AS key
  FROM (SELECT row, lines, unnest(range(1, len(lines) + 1)) AS i FROM split)),
common AS (SELECT key FROM lines WHERE key <> '' GROUP BY key HAVING count(DISTINCT row) >= 10),
kept AS (
  SELECT row, count(*) AS n_lines, count(common.key) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE common.key IS NULL), '') AS text
  FROM lines LEFT JOIN common USING (key) GROUP BY row)
SELECT doc_id, n_lines, n_dropped, sha256(kept.text) AS kept_sha256 FROM kept JOIN docs USING (row)
"""


def _shingles(table: str, key: str) -> str:
    """Distinct shingles of every row's text: five words in a row, or all of fewer."""
    return f"""SELECT DISTINCT {key}, array_to_string(words[i:i + 4], ' ') AS shingle
  FROM (SELECT {key}, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i
        FROM (SELECT {key}, regexp_extract_all({_LOWER.format('text')}, '[^\\x20\\x09-\\x0D]+') AS words
              FROM {table} WHERE text IS NOT NULL)
        WHERE len(words) > 0)"""


OP3 = f"""
WITH RECURSIVE shingles AS ({_shingles('documents', 'doc_id')}),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS one, b.doc_id AS two, count(*) AS n
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT one, two FROM common JOIN sizes a ON a.doc_id = one JOIN sizes b ON b.doc_id = two
  WHERE 100 * common.n >= 85 * (a.n + b.n - common.n)),
both_ways AS (SELECT one, two FROM links UNION ALL SELECT two, one FROM links),
reached AS (
  SELECT doc_id AS start, doc_id AS place FROM documents
  UNION
  SELECT start, two FROM reached JOIN both_ways ON place = one),
lowest AS (SELECT start, min(place) AS low FROM reached GROUP BY start)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, low AS component_id, doc_id = low AS kept
FROM documents JOIN lowest ON doc_id = start LEFT JOIN sizes USING (doc_id)
"""

OP7 = f"""
WITH items AS ({_shingles('benchmark', 'item_id')}),
docs AS ({_shingles('documents', 'doc_id')}),
sizes AS (SELECT item_id, count(*) AS n FROM items GROUP BY item_id),
found AS (SELECT item_id, doc_id, count(*) AS shared FROM items JOIN docs USING (shingle) GROUP BY 1, 2)
SELECT item_id, doc_id, shared, n AS item_shingles FROM found JOIN sizes USING (item_id) WHERE 5 * shared >= 4 * n
"""

# Fixed value: the terms of lexical search.
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

OP11 = f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, text FROM documents),
terms AS (
  SELECT row, unnest(regexp_extract_all({_LOWER.format('text')}, '{_TERM}')) AS term FROM docs),
lengths AS (SELECT row, count(*) AS n FROM terms GROUP BY row),
whole AS (SELECT CAST(count(*) AS BIGINT) AS documents, CAST(sum(n) AS BIGINT) AS length FROM lengths),
held AS (SELECT row, term, count(*) AS tf FROM terms GROUP BY row, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(documents) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM held, whole GROUP BY term),
wanted AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest(regexp_extract_all({_LOWER.format('text')}, '{_TERM}')) AS term FROM benchmark)
  GROUP BY item_id, term),
scored AS (
  SELECT item_id, row,
         CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * documents) // length)))) AS BIGINT) AS score
  FROM wanted JOIN weights USING (term) JOIN held USING (term) JOIN lengths USING (row), whole
  GROUP BY item_id, row)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored JOIN docs USING (row) WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 20
"""

ORACLES = {
    "op3_near_components": OP3,
    "op6_mix_sources": OP6,
    "op7_benchmark_items": OP7,
    "op10_line_runs": OP10,
    "op11_shared_ranking": OP11,
}
