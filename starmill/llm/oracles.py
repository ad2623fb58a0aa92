"""SQL of the operators' results, where SQL can express them."""

# Words of documents and items in order; a window is ten words in a row, or all of a shorter item.
DECONTAMINATION = """
WITH doc AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS w
  FROM documents
), item AS (
  SELECT item_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS w
  FROM benchmark
), win AS (
  SELECT DISTINCT item_id, array_to_string(w[s : s + 9], ' ') AS win, least(len(w), 10) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s
        FROM item WHERE len(w) > 0)
), sizes AS (
  SELECT DISTINCT n FROM win
), place AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS s, w FROM doc, sizes WHERE len(w) >= n
), hit AS (
  SELECT p.doc_id, p.s, p.n, win.item_id
  FROM (SELECT doc_id, n, s, array_to_string(w[s : s + n - 1], ' ') AS win FROM place) p
  JOIN win ON win.win = p.win AND win.n = p.n
), covered AS (
  SELECT doc_id, count(DISTINCT i) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + n)) AS i FROM (SELECT DISTINCT doc_id, s, n FROM hit))
  GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id
)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words,
       CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

URL_RULES = r"""
WITH part AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0
    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parsed AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM part
), rules(verdict, rhost, rpath) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
         ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), best AS (
  SELECT page_id, host, path, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
         arg_max(verdict, length(rhost || rpath)) AS verdict
  FROM parsed LEFT JOIN rules
    ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY page_id, host, path
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM best
"""

FILTER_AUDIT = r"""
WITH doc AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                     lambda w: w <> '') AS w
  FROM documents
), mask AS (
  SELECT doc_id, part,
    (len(w) < 100)::INT + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::INT
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT
    + 16 * coalesce(min(doc_id) OVER (PARTITION BY t) < doc_id, false)::INT AS m
  FROM doc
), mark AS (
  SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good,
         bool_or(coalesce(toxic = 1, false)) AS toxic
  FROM labels GROUP BY doc_id
), combo AS (
  SELECT part, m, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM mask LEFT JOIN mark USING (doc_id) GROUP BY part, m
), letter(k, bit) AS (
  VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)
), orders AS (
  SELECT a.k || b.k || c.k || d.k || e.k AS filter_order
  FROM letter a, letter b, letter c, letter d, letter e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5
), steps AS (
  SELECT filter_order, step, bit AS own,
    (SELECT coalesce(sum(x.bit), 0)::BIGINT FROM letter x
     WHERE strpos(substr(filter_order, 1, step - 1), x.k) > 0) AS before
  FROM orders, (SELECT unnest(range(1, 6)) AS step), letter
  WHERE k = substr(filter_order, step, 1)
)
, counted AS (
  SELECT part, filter_order, step, own,
    coalesce(sum(n) FILTER (m & own = 0 AND m & before = 0), 0) AS kept,
    coalesce(sum(n) FILTER (m & own <> 0 AND m & before = 0), 0) AS removed,
    coalesce(sum(n) FILTER (m & own <> 0 AND m & before <> 0), 0) AS redundant,
    coalesce(sum(n) FILTER (m = own), 0) AS unique_fails,
    coalesce(sum(good) FILTER (m & own <> 0 AND m & before = 0), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (m & own <> 0 AND m & before = 0), 0) AS toxic_lost
  FROM combo, steps GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
  CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM counted
"""

_LEAF = """sha256(
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-')
    || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-')
    || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-')
    || coalesce(strlen({text}) || ':' || {text}, '-'))"""

# Checksums of ids are computed bit by bit, as DuckDB has none of its own.
_CRC = """(list_reduce(
      list_concat([4294967295::BIGINT], list_transform(range(1, strlen(doc_id::VARCHAR) + 1),
        lambda i: ord(substr(doc_id::VARCHAR, i, 1))::BIGINT)),
      lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)),
        lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""

MERKLE_MANIFEST = f"""
WITH RECURSIVE doc AS (
  SELECT row_number() OVER () AS k, *, {_LEAF.format(text="text")} AS leaf,
    CASE WHEN xor({_CRC}, 4294967295) % 5 = 0
      THEN {_LEAF.format(text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
    END AS other
  FROM documents
), leaf AS (
  SELECT k, doc_id, source AS src, leaf, coalesce(other, leaf) AS found,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    count(*) OVER (PARTITION BY source) AS n
  FROM doc
), node(src, l, i, n, h) AS (
  SELECT src, 0, i, n, leaf FROM leaf
  UNION ALL
  SELECT src, l + 1, i // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY i))
  FROM node WHERE n > 1 GROUP BY src, l, i // 16, (n + 15) // 16
), sub AS (
  SELECT src, l AS last, h, row_number() OVER (ORDER BY src NULLS FIRST) - 1 AS i,
    count(*) OVER () AS n
  FROM node WHERE n = 1
), top(l, i, n, h) AS (
  SELECT 0, i, n, h FROM sub
  UNION ALL
  SELECT l + 1, i // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY i))
  FROM top WHERE n > 1 GROUP BY l, i // 16, (n + 15) // 16
), run AS (
  SELECT src, l, i // 16 AS r, list(h ORDER BY i) AS hs FROM node WHERE n > 1 GROUP BY src, l, i // 16
), top_run AS (
  SELECT l, i // 16 AS r, list(h ORDER BY i) AS hs FROM top WHERE n > 1 GROUP BY l, i // 16
), low(k, src, l, i, f, p) AS (
  SELECT k, src, 0, i, found, '' FROM leaf
  UNION ALL
  SELECT k, low.src, low.l + 1, r,
    sha256(array_to_string(list_concat(hs[1 : i % 16], [f], hs[i % 16 + 2 : 16]), '')),
    p || array_to_string(list_concat(hs[1 : i % 16], hs[i % 16 + 2 : 16]), '')
  FROM low JOIN run ON run.src IS NOT DISTINCT FROM low.src AND run.l = low.l AND r = i // 16
), high(k, l, i, f, p) AS (
  SELECT k, 0, sub.i, f, p
  FROM low JOIN sub ON sub.src IS NOT DISTINCT FROM low.src AND sub.last = low.l
  UNION ALL
  SELECT k, high.l + 1, r,
    sha256(array_to_string(list_concat(hs[1 : i % 16], [f], hs[i % 16 + 2 : 16]), '')),
    p || array_to_string(list_concat(hs[1 : i % 16], hs[i % 16 + 2 : 16]), '')
  FROM high JOIN top_run ON top_run.l = high.l AND r = i // 16
), root AS (
  SELECT l AS last, h FROM top WHERE n = 1
)
SELECT doc_id, leaf, sub.h AS subroot, root.h AS root, sha256(p) AS proof_sha256,
  f AS folded_root, f = root.h AS verified
FROM leaf JOIN sub ON sub.src IS NOT DISTINCT FROM leaf.src, root, high
WHERE high.k = leaf.k AND high.l = root.last
"""
