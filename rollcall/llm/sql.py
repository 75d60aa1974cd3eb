"""SQL of the longer queries."""

NEGATIVES = """
WITH kept AS (
    SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.r, a.vec_id AS anchor_id, o.vec_id, o.label = a.label AS alike, CAST(list_dot_product(a.v, o.v) AS BIGINT) AS score
    FROM kept a JOIN kept o ON a.vec_id % 100 = 0 AND a.vec_id <> o.vec_id AND len(a.v) = len(o.v)
), positives AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS place FROM scored WHERE alike)
    WHERE place <= 5
), negatives AS (
    SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
        CAST(row_number() OVER (PARTITION BY p.r, p.place ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS "rank"
    FROM positives p JOIN scored n ON n.r = p.r AND NOT n.alike
        AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
)
SELECT anchor_id, positive_id, "rank", negative_id, positive_score, negative_score FROM negatives WHERE "rank" <= 10
"""


def _mixing(classes: tuple[int, ...] = (8, 64, 512)) -> str:
    length = "CASE " + " ".join(f"WHEN size * {part} > rest THEN {n}" for n, part in enumerate(classes)) + f" ELSE {len(classes)} END"
    steps = []
    for n in range(len(classes) + 1):
        before = f"coalesce((SELECT missed FROM took{n - 1} t WHERE t.place = r.place), 0.0)" if n else "0.0"
        steps.append(f"""class{n} AS (
    SELECT place, number, greatest({before} + sum(counts) OVER p * rest / counting, 0.0) AS budget, size,
        sum(size) OVER (p ORDER BY rank, u, size, CAST(doc_id AS VARCHAR) ROWS UNBOUNDED PRECEDING) AS run
    FROM ranked r WHERE length = {n} WINDOW p AS (PARTITION BY place)
), chosen{n} AS (SELECT *, 2 * run - size < 2 * budget AS chosen FROM class{n}
), took{n} AS (
    SELECT s.place, coalesce(max(c.budget), greatest({before.replace('r.place', 's.place')}, 0.0))
        - coalesce(sum(c.size) FILTER (WHERE c.chosen), 0) AS missed
    FROM figures s LEFT JOIN chosen{n} c ON c.place = s.place GROUP BY s.place
)""")
    chosen = " UNION ALL ".join(f"SELECT number FROM chosen{n} WHERE chosen" for n in range(len(classes) + 1))
    return f"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY source, doc_id, size) AS copy, row_number() OVER () AS number FROM sized
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) AS place
    FROM sized GROUP BY source
), weighed AS (
    SELECT *, 2.0 * source_size AS most, CAST([5, 2, 1][(place - 1) % 3 + 1] AS DOUBLE) AS weight FROM sources
), levels AS (
    SELECT *, most / weight AS stops, (1.5 * sum(source_size) OVER ()
            - coalesce(sum(most) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighed WINDOW o AS (ORDER BY most / weight, place)
), figures AS (
    SELECT place, source, source_size, target, copies, greatest(target - copies * source_size, 0.0) AS rest FROM (
        SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS copies FROM (
            SELECT *, least(most, coalesce((SELECT min_by(level, stops) FROM levels WHERE level <= stops) * weight, most)) AS target
            FROM levels))
), drawn AS (
    SELECT n.*, f.* EXCLUDE (source), greatest(ceil(rest / {classes[0]}), 1) AS long,
        (CAST('0x' || substr(md5(concat_ws('|', 1, coalesce(n.source, ''), coalesce(CAST(doc_id AS VARCHAR), ''), size, copy)), 1, 13)
            AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
    FROM numbered n JOIN figures f ON n.source IS NOT DISTINCT FROM f.source
), counted AS (
    SELECT *, least(size, long) AS counts, sum(least(size, long)) OVER (PARTITION BY place) AS counting, {length} AS cls FROM drawn
), chances AS (
    SELECT *, least(CASE WHEN counting > 0 THEN rest / counting ELSE 0 END, 1023 / 1024::DOUBLE) * least(1.0::DOUBLE, long / size) AS chance
    FROM counted WHERE rest > 0 AND size > 0
), ranked AS (
    SELECT *, cls AS length, u / (1 - u) / (chance / (1 - chance)) AS rank FROM chances
), {', '.join(steps)}
SELECT doc_id, CAST(d.size AS BIGINT) AS size, source_size, CAST(target AS DOUBLE) AS target,
    CAST((copies + CASE WHEN number IN (SELECT number FROM ({chosen})) THEN 1 ELSE 0 END) * d.size AS BIGINT) AS taken
FROM drawn d
"""


MIXING = _mixing()


def _conversations() -> str:
    # States of the grammar: 0 the beginning, 1 after system, 2 after user, 3 after assistant.
    after, wanted = (2, 2, 3, 2), "uuau"

    def best(options: list[str]) -> str:
        return f"list_sort([{', '.join(options)}])[1]"

    def option(cost: str, letter: str, state: int, of: str) -> str:
        return f"{{'c': {cost} + {of}{state}.c, 'a': '{letter}' || {of}{state}.a}}"

    def edits(state: int) -> str:
        never = "{'c': 1000000, 'a': ''}"
        keep = option("more", "K", after[state], "f")
        found = [option("2", "D", state, "f"),
                 f"CASE WHEN gone THEN {never} ELSE {option('1 + more', 'R', after[state], 'f')} END",
                 f"CASE WHEN NOT gone AND initial = '{wanted[state]}' THEN {keep} ELSE {never} END"]
        if state == 0:
            found.append(f"CASE WHEN NOT gone AND initial = 's' THEN {option('more', 'K', 1, 'f')} ELSE {never} END")
        return best(found)

    def inserted(of: str, to: str) -> str:
        return ", ".join(f"{best([f'{of}{s}', option('5', 'I', after[s], of)])} AS {to}{s}" for s in range(4))

    ends = ", ".join(("{'c': 0, 'a': ''}", "{'c': 10, 'a': 'II'}", "{'c': 5, 'a': 'I'}", "{'c': 0, 'a': ''}")[s] + f" AS f{s}" for s in range(4))
    return rf"""
WITH RECURSIVE fates AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations
), bits AS (
    SELECT n, CAST(list_reduce(list_concat([n], range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS BIGINT) AS crc
    FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS n)
), crctable AS (SELECT list(crc ORDER BY n) AS t FROM bits
), named AS (
    SELECT DISTINCT name FROM fates
), crcs AS (
    SELECT name, xor(list_reduce(list_concat([4294967295], list_transform(string_split(name, ''), lambda x: CAST(ascii(x) AS BIGINT))),
        lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])), 4294967295) % 20 AS fate
    FROM named, crctable
), damaged AS (
    SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
        CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
        unnest(CASE fate WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM fates JOIN crcs USING (name)
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS place FROM damaged
), faults AS (
    SELECT *, CASE WHEN ended = '' THEN 'blank'
        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'duplicate'
        WHEN right(ended, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
        left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY place) AS before
    FROM (SELECT *, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS ended FROM numbered)
), counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
        count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
        count(*) FILTER (WHERE before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(place) AS n
    FROM faults GROUP BY conv_id
), best AS (
    SELECT conv_id, n AS place, {ends} FROM counts
    UNION ALL
    SELECT conv_id, place - 1, {inserted('h', 'f')} FROM (
        SELECT conv_id, place, {inserted('g', 'h')} FROM (
            SELECT b.conv_id, b.place, {', '.join(f'{edits(s)} AS g{s}' for s in range(4))}
            FROM best b JOIN (SELECT conv_id, place, initial, fault IN ('blank', 'duplicate') AS gone,
                CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS more FROM faults) r
                ON b.conv_id IS NOT DISTINCT FROM r.conv_id AND b.place = r.place))
), solved AS (
    SELECT conv_id, f0.c AS cost, f0.a AS audit FROM best WHERE place = 0
), letters AS (
    SELECT conv_id, i, audit[i] AS edit, len(replace(audit[1 : i], 'I', '')) AS place, left(audit, i) AS upto
    FROM (SELECT conv_id, audit, CAST(unnest(range(1, len(audit) + 1)) AS BIGINT) AS i FROM solved)
), results AS (
    SELECT l.conv_id, i, edit, CASE WHEN edit <> 'I' THEN f.role END AS role, CASE WHEN edit = 'I' THEN '' ELSE f.text END AS text,
        row_number() OVER (PARTITION BY l.conv_id ORDER BY i) AS nth
    FROM letters l LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM l.conv_id AND f.place = l.place WHERE edit <> 'D'
), starts AS (
    SELECT conv_id, bool_or(nth = 1 AND edit = 'K' AND left(role, 1) = 's') AS system FROM results GROUP BY conv_id
), hashed AS (
    SELECT r.conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (nth - CAST(system AS INTEGER)) % 2 = 1 THEN 'user' ELSE 'assistant' END
        || ':' || text, chr(10) ORDER BY nth)) AS repaired_sha256
    FROM results r JOIN starts s ON r.conv_id IS NOT DISTINCT FROM s.conv_id GROUP BY r.conv_id
), ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit,
    coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM ids i LEFT JOIN counts c ON i.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN solved s ON i.conv_id IS NOT DISTINCT FROM s.conv_id
LEFT JOIN hashed h ON i.conv_id IS NOT DISTINCT FROM h.conv_id
"""


CONVERSATIONS = _conversations()
