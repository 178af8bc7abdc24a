"""SQL with the same result, for the queries that SQL can express over whole tables."""

ARCHIVES = """
    WITH payloads AS (
      SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
    held AS (
      SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest)
                     ELSE page_id END AS response_id
      FROM payloads)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN response_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN response_id <> page_id THEN response_id END AS refers_to
    FROM held"""

NEAR_DUPLICATES = r"""
    WITH RECURSIVE words AS (
      SELECT doc_id, list_filter(
        string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
      FROM documents),
    shingles AS (
      SELECT DISTINCT doc_id, unnest(
        CASE WHEN len(w) < 2 THEN w
             ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS shingle
      FROM words),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    links AS (
      SELECT a.doc_id AS u, b.doc_id AS v
      FROM shingles a JOIN shingles b USING (shingle)
      JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
      WHERE a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
    reach AS (
      SELECT doc_id, doc_id AS other FROM documents
      UNION SELECT reach.doc_id, links.v FROM reach JOIN links ON links.u = reach.other),
    components AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
    FROM documents LEFT JOIN sizes USING (doc_id) JOIN components USING (doc_id)"""

FILTER_AUDIT = r"""
    WITH texts AS (
      SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body FROM documents),
    words AS (
      SELECT *, list_filter(string_split_regex(body, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM texts),
    first_ids AS (SELECT body AS held, min(doc_id) AS first_id FROM texts GROUP BY body),
    marks AS (SELECT doc_id AS labelled, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
    judged AS (
      SELECT part, CASE WHEN len(w) < 200 THEN 'A' ELSE '' END
        || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
        || CASE WHEN 100 * (length(body) - length(regexp_replace(body, '[A-Z]', '', 'g'))) > 2 * length(body) THEN 'C' ELSE '' END
        || CASE WHEN regexp_matches(body, '[#$%&*|]') THEN 'D' ELSE '' END
        || CASE WHEN first_id < doc_id THEN 'E' ELSE '' END AS fails,
        coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
      FROM words JOIN first_ids ON body = held LEFT JOIN marks ON doc_id = labelled),
    counted AS (SELECT part, fails, good, toxic, count(*) AS n FROM judged GROUP BY ALL),
    letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter),
    orders AS (
      SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
      FROM letters a, letters b, letters c, letters d, letters e
      WHERE len(list_distinct([a.letter, b.letter, c.letter, d.letter, e.letter])) = 5),
    steps AS (
      SELECT filter_order, step, filter_order[step] AS letter, filter_order[1:step - 1] AS earlier
      FROM orders, (SELECT unnest([1, 2, 3, 4, 5])::INTEGER AS step)),
    judged_steps AS (
      SELECT part, filter_order, step, n, good, toxic, fails, letter, contains(fails, letter) AS failed,
        len(list_filter(string_split(earlier, ''), lambda l: l <> '' AND contains(fails, l))) > 0 AS gone
      FROM counted, steps),
    sums AS (
      SELECT part, filter_order, step, letter,
        coalesce(sum(n) FILTER (NOT failed AND NOT gone), 0)::BIGINT AS kept,
        coalesce(sum(n) FILTER (failed AND NOT gone), 0)::BIGINT AS removed,
        coalesce(sum(n) FILTER (failed AND gone), 0)::BIGINT AS redundant,
        coalesce(sum(n) FILTER (fails = letter), 0)::BIGINT AS unique_fails,
        coalesce(sum(n) FILTER (failed AND NOT gone AND good), 0)::BIGINT AS good_lost,
        coalesce(sum(n) FILTER (failed AND NOT gone AND toxic), 0)::BIGINT AS toxic_lost
      FROM judged_steps GROUP BY ALL),
    shares AS (SELECT part, letter, sum(removed)::BIGINT AS shapley FROM sums GROUP BY ALL)
    SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley
    FROM sums JOIN shares USING (part, letter)"""
