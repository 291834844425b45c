"""SQL for the queries that SQL can express."""

from __future__ import annotations

from tillflow.llm.curriculum import SCHEDULES

_WORD = r"[^\x20\x09-\x0D]+"
_DIGEST = "md5(coalesce(doc_id::VARCHAR, 'null') || '/' || coalesce(text, ''))"


def _draw(name: str, weight: int) -> str:
    return f"(-ln((('0x' || substr(md5(k || '@' || {name}), 1, 13))::BIGINT + 1) / 4503599627370496.0::DOUBLE) / {weight})"


def _best(names: str, count: int, weight: int) -> str:
    draws = f"list_transform(range({count}), lambda i: {_draw(names, weight)})"
    return f"(list_position({draws}, list_min({draws})) - 1)"


# The checksum table is the reflected polynomial's, made by shifting.
OP1 = f"""
WITH RECURSIVE bits(n, c, step) AS (
  SELECT r, r::UBIGINT, 0 FROM range(256) x(r)
  UNION ALL
  SELECT n, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, step + 1 FROM bits WHERE step < 8),
crc AS (SELECT list(c ORDER BY n) AS t FROM bits WHERE step = 8),
docs AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0) + 1 AS size, {_DIGEST} AS digest,
    coalesce(doc_id::VARCHAR, 'null') AS k, hex(encode(coalesce(text, ''))) AS h
  FROM documents),
summed AS (
  SELECT doc_id, size, digest, k,
    xor(list_reduce(list_prepend(4294967295::UBIGINT,
          list_transform(range(size - 1), lambda i: ('0x' || substr(h, 1 + 2 * i::INT, 2))::UBIGINT)),
        lambda a, b: xor(a >> 8, t[1 + xor(a & 255, b)::INT])), 4294967295::UBIGINT)::BIGINT AS text_crc32
  FROM docs, crc),
regions AS (SELECT *, {_best("i::VARCHAR", 2, 8)} AS region FROM summed),
racks AS (SELECT *, {_best("region::VARCHAR || '.' || i::VARCHAR", 2, 4)} AS rack FROM regions),
leaves AS (SELECT *, {_best("region::VARCHAR || '.' || rack::VARCHAR || '.' || i::VARCHAR", 4, 1)} AS leaf FROM racks),
placed AS (SELECT *, 8 * region + 4 * rack + leaf AS shard FROM leaves)
SELECT doc_id, size, text_crc32, 'key' AS law, region::INT AS region, rack::INT AS rack, shard::INT AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY digest, doc_id, size, text_crc32) - 1 AS slot,
  CASE WHEN {_draw("'2'", 1)} < least({_draw("'0'", 8)}, {_draw("'1'", 8)}) THEN 16 ELSE shard END::INT AS grown_shard
FROM placed
"""


def _moment() -> str:
    """Time by class, from the straight pieces of each schedule."""
    cases = []
    for klass, schedule in enumerate(SCHEDULES):
        for t, done, a, slope in reversed(schedule.segments()):
            more = f"(part - {done!r}::DOUBLE)"
            root = f"sqrt(greatest({a!r}::DOUBLE * {a!r}::DOUBLE + 2 * {slope!r}::DOUBLE * {more}, 0.0::DOUBLE))"
            cases.append(f"WHEN class = {klass} AND part >= {done!r}::DOUBLE THEN CASE WHEN {more} <= 0 THEN {t!r}::DOUBLE "
                         f"ELSE least({t!r}::DOUBLE + 2 * {more} / ({a!r}::DOUBLE + {root}), 1.0::DOUBLE) END")
    return "CASE " + " ".join(cases) + " END"


OP5 = f"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORD}')), 0)::BIGINT AS size, {_DIGEST} AS digest
  FROM documents),
sized AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
ranked AS (
  SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT AS class FROM sized),
weighed AS (
  SELECT *, ([5.0, 2.0, 1.0]::DOUBLE[])[class + 1] AS w, source_size * 2.0::DOUBLE AS cap FROM ranked),
levels AS (
  SELECT *, cap / w AS ratio,
    (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER lower_ones, 0))
      / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed
  WINDOW lower_ones AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
plan AS (
  SELECT source, source_size, class,
    coalesce(least(cap, w * max(level) FILTER (WHERE ratio >= level) OVER ()), cap) AS target
  FROM levels),
placed AS (
  SELECT docs.doc_id, docs.source, docs.size, plan.source_size, plan.class, plan.target,
    coalesce(sum(docs.size) OVER (PARTITION BY docs.source ORDER BY digest, docs.doc_id, docs.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begin
  FROM docs JOIN plan ON docs.source IS NOT DISTINCT FROM plan.source),
passes AS (
  SELECT *, greatest(least(floor(target)::BIGINT - begin, size), 0) AS first,
    greatest(least(floor(target)::BIGINT - begin - source_size, size), 0) AS second, begin / target AS part
  FROM placed)
SELECT doc_id, source, size, source_size, target, (first + second)::BIGINT AS taken,
  CASE WHEN first > 0 THEN {_moment()} END AS position
FROM passes
"""

_BARE = r"regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')"

OP3 = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
split AS (
  SELECT r, source, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM docs),
bare AS (SELECT *, {_BARE} AS b FROM split),
counts AS (SELECT source, b, count(DISTINCT r) AS n FROM bare WHERE b <> '' GROUP BY source, b),
totals AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
boilerplate AS (
  SELECT counts.source, b FROM counts JOIN totals ON counts.source IS NOT DISTINCT FROM totals.source
  WHERE n >= 5 AND n > pages * 0.05::DOUBLE),
kept AS (
  SELECT r, coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE x.b IS NULL), '') AS text,
    count(x.b) AS n_dropped
  FROM bare LEFT JOIN boilerplate x ON bare.source IS NOT DISTINCT FROM x.source AND bare.b = x.b
  GROUP BY r)
SELECT docs.doc_id, docs.source, CASE WHEN docs.text IS NULL THEN NULL ELSE kept.text END AS text,
  coalesce(len(docs.lines), 0)::BIGINT AS n_lines, coalesce(kept.n_dropped, 0)::BIGINT AS n_dropped
FROM docs LEFT JOIN kept USING (r)
"""

OP13 = r"""
WITH docs AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER same AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
  row_number() OVER same = 1 AS kept, text_sha256
FROM docs WINDOW same AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST)
"""

OP12 = r"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
marks AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
  FROM labels GROUP BY doc_id),
masks AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, [
    CASE WHEN len(words) < 200 THEN 'A' END,
    CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' END,
    CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 'C' END,
    CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' END,
    CASE WHEN words.doc_id > first THEN 'E' END] AS slots
  FROM words LEFT JOIN marks USING (doc_id)),
counts AS (
  SELECT part, good, toxic, list_filter(slots, lambda x: x IS NOT NULL) AS fails, count(*) AS n FROM masks GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (
  SELECT *, unnest([1, 2, 3, 4, 5])::INT AS step FROM orders),
found AS (
  SELECT part, good, toxic, n, filter_order, step, list_contains(fails, substr(filter_order, step, 1)) AS own,
    len(fails) AS failed, list_bool_or([false] || list_transform(fails, lambda x: instr(filter_order, x) < step)) AS before
  FROM counts, steps)
SELECT part, filter_order, step,
  sum(CASE WHEN NOT own AND NOT before THEN n ELSE 0 END)::BIGINT AS kept,
  sum(CASE WHEN own AND NOT before THEN n ELSE 0 END)::BIGINT AS removed,
  sum(CASE WHEN own AND before THEN n ELSE 0 END)::BIGINT AS redundant,
  sum(CASE WHEN own AND failed = 1 THEN n ELSE 0 END)::BIGINT AS unique_fails,
  sum(CASE WHEN own AND NOT before AND good THEN n ELSE 0 END)::BIGINT AS good_lost,
  sum(CASE WHEN own AND NOT before AND toxic THEN n ELSE 0 END)::BIGINT AS toxic_lost,
  sum(CASE WHEN own THEN n * 120 // failed ELSE 0 END)::BIGINT AS shapley
FROM found GROUP BY part, filter_order, step
"""
