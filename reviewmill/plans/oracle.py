"""The catalogue's queries again, as SQL for a second engine.

Written from the rules, not from the jobs: joins and windows where a job aggregates, cross
products where a job keys, so agreement says something.
"""

from __future__ import annotations

from reviewmill.plans import views

_NEAR = "regexp_matches(review_id, '(?i)(_copy|_dup)$')"
_BASE = "regexp_replace(review_id, '(?i)(_copy|_dup)$', '')"
_NUMERIC = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_NON_SYMBOL = r"[\x{FE00}-\x{FE0F}\x{200D}\p{L}\p{N}_\t-\r\x1c-\x20\x{85}\p{Z}]"
_SPACE = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"
_PASS = ("review_text", "customer_id", "party_size", "age_range", "gender", "ethnicity", "total_spent", "tip_amount")
_NULLED = ("customer_id", "total_spent", "tip_amount", "party_size", "age_range", "gender", "ethnicity")


def _with(**ctes: str) -> str:
    return "WITH " + ", ".join(f"{name} AS ({sql})" for name, sql in ctes.items())


def _number(cell: str) -> str:
    return f"CASE WHEN regexp_matches(trim({cell}), '{_NUMERIC}') THEN TRY_CAST(trim({cell}) AS DOUBLE) END"


def _symbol_count(cell: str) -> str:
    return f"length(regexp_replace({cell}, '{_NON_SYMBOL}', '', 'g'))"


def _outcome(cell: str) -> str:
    return (
        f"CASE WHEN {cell} IS NULL THEN 'missing' WHEN ({_number(cell)}) IS NOT NULL THEN 'numeric' "
        f"WHEN NOT regexp_matches({cell}, '[A-Za-z0-9]') AND {_symbol_count(cell)} > 0 THEN 'symbol' ELSE 'unparseable' END"
    )


def _rating(cell: str) -> str:
    return (
        f"CASE {_outcome(cell)} WHEN 'numeric' THEN round_even(({_number(cell)}) / 2, 1)::DOUBLE "
        f"WHEN 'symbol' THEN {_symbol_count(cell)}::DOUBLE END"
    )


def _date(cell: str) -> str:
    return f"coalesce(try_strptime({cell}, '%Y-%m-%d'), try_strptime({cell}, '%m/%d/%Y'), try_strptime({cell}, '%d.%m.%Y'))::DATE"


RAW = views.oracle_text(views.REVIEWS_RAW)
_NEEDS_TOTAL = "total_spent IS NULL AND tip_amount > 0 AND tip_percentage > 0"
_TOTAL = "round_even(tip_amount / (tip_percentage / 100) * 100, 0)::DOUBLE / 100"


def _facts(compat: bool = False) -> dict[str, str]:
    """CTEs ending in ``facts``; dates stay dates."""
    cell = "rating" if compat else "rating_value"
    picked = _rating("g.rating_cell") if compat else "g.rating_cell"
    return {
        "raw": RAW,
        "parsed": f"SELECT *, {_date('review_date')} AS day, {_rating('rating')} AS rating_value, {_NEAR} AS near FROM raw WHERE review_id IS NOT NULL",
        "nears": f"SELECT source, {_BASE} AS review_id, count(*) AS n FROM parsed WHERE near GROUP BY ALL",
        "sized": "SELECT p.*, count(*) OVER (PARTITION BY p.source, p.review_id) + coalesce(n.n, 0) AS transaction_count FROM (SELECT * FROM parsed WHERE NOT near) p LEFT JOIN nears n USING (source, review_id)",
        "grouped": f"""SELECT source, review_id, min(pos) AS first_pos,
            arg_min(day, pos) FILTER (day IS NOT NULL) AS review_date,
            arg_min({cell}, pos) FILTER ({cell} IS NOT NULL) AS rating_cell,
            arg_min(review_text, pos) FILTER (review_text IS NOT NULL) AS review_text
            FROM sized GROUP BY source, review_id""",
        "facts": f"""SELECT s.review_id, CASE WHEN transaction_count = 1 THEN customer_id END AS customer_id, g.review_date,
            {picked} AS rating, g.review_text,
            CASE WHEN transaction_count = 1 THEN CASE WHEN {_NEEDS_TOTAL} THEN {_TOTAL} ELSE total_spent END END AS total_spent,
            CASE WHEN transaction_count = 1 THEN tip_amount END AS tip_amount,
            CASE WHEN transaction_count = 1 THEN party_size END AS party_size,
            CASE WHEN transaction_count = 1 THEN age_range END AS age_range,
            CASE WHEN transaction_count = 1 THEN gender END AS gender,
            CASE WHEN transaction_count = 1 THEN ethnicity END AS ethnicity,
            transaction_count, s.source AS restaurant_id
            FROM sized s JOIN grouped g ON s.source = g.source AND s.review_id = g.review_id AND s.pos = g.first_pos""",
    }


_DIMENSION = {
    "dimension_raw": views.oracle_text(views.DIMENSION_RAW),
    "dimension": """SELECT location AS source_file_tag, restaurant_name, original_city, address,
        list_transform(string_split(categories, ','), lambda c: trim(c)) AS categories, lower(location) AS restaurant_id FROM dimension_raw""",
}
_NATIONS = views.oracle_text(views.NATION_DIMENSION)
_DICTIONARY = f"SELECT lower(trim(restaurant_name)) AS name, arg_max(lower(trim(location)), pos) AS restaurant_id FROM ({_NATIONS}) GROUP BY 1"


def _facts_text(compat: bool) -> str:
    return _with(**_facts(compat)) + " SELECT * REPLACE (strftime(review_date, '%Y-%m-%d') AS review_date) FROM facts"


def _sampled(failures: str, key: str = "review_id", n: int = 25) -> str:
    return (
        f"SELECT check_id, dataset, count(*) AS n_bad, array_to_string(list_sort(list({key}))[1:{n}], '|') AS sample_ids "
        f"FROM ({failures}) GROUP BY check_id, dataset"
    )


def _blank_text(cell: str) -> str:
    return f"NOT coalesce(regexp_matches({cell}, '[^{_SPACE[1:-1]}]'), false)"


def _row_failures(facts: str, date_bad: str, dataset: str = "restaurant_id") -> str:
    rules = {
        "rating_domain": "rating IS NOT NULL AND rating NOT IN (1, 2, 3, 4, 5)",
        "date_format": date_bad,
        "near_dup_left": _NEAR,
        "id_encoding": f"NOT ({_lenient('review_id')}) OR review_id = ''",
        "restaurant_mismatch": f"lower(restaurant_id) IS DISTINCT FROM lower({dataset})",
    }
    for field in _NULLED:
        blank = f"{field} IS NULL" if field in ("total_spent", "tip_amount", "party_size") else _blank_text(field)
        rules[f"not_nulled_{field}"] = f"transaction_count > 1 AND NOT ({blank})"
    return " UNION ALL ".join(
        f"SELECT '{name}' AS check_id, {dataset} AS dataset, review_id FROM {facts} WHERE {rule}" for name, rule in rules.items()
    )


def _lenient(cell: str) -> str:
    pads = f"((4 - length({cell}) % 4) % 4)"
    digits = f"length(regexp_replace({cell}, '[^A-Za-z0-9+/_-]', '', 'g'))"
    reduced = f"regexp_replace(regexp_replace({cell}, '[^A-Za-z0-9+/_=-]', '', 'g'), '[A-Za-z0-9+/_-]', 'x', 'g')"
    embedded = f"regexp_matches({reduced} || repeat('=', {pads}), '^(?:=*x=*x=?xx)*(?:=*$|=*x=*x(?:==|=?x=))')"
    plain = f"({digits} % 4 = 0 OR ({digits} % 4 = 2 AND {pads} >= 2) OR ({digits} % 4 = 3 AND {pads} >= 1))"
    return f"coalesce(regexp_full_match({cell}, '[\\x00-\\x7F]*') AND CASE WHEN contains({cell}, '=') THEN {embedded} ELSE {plain} END, false)"


def _strict(cell: str) -> str:
    bare = f"length(replace({cell}, '=', ''))"
    return (
        f"coalesce(regexp_full_match({cell}, '[A-Za-z0-9_-]*={{0,2}}') AND {bare} % 4 <> 1 "
        f"AND ({bare} = length({cell}) OR length({cell}) % 4 = 0), false)"
    )


def _id_failures(facts: str) -> str:
    """Raw against ``facts`` by joins on (dataset, review_id)."""
    def blank(c: str, alias: str) -> str:
        cell = f"{alias}.{c}"
        if c in ("total_spent", "tip_amount", "party_size"):
            return f"{cell} IS NULL"
        return _blank_text(cell)

    parts = [
        f"""SELECT 'rating_lost' AS check_id, f.restaurant_id AS dataset, f.review_id FROM {facts} f WHERE f.rating IS NULL AND EXISTS
            (SELECT 1 FROM raw r WHERE r.source = f.restaurant_id AND r.review_id = f.review_id AND NOT ({blank('rating', 'r')}))""",
        f"""SELECT 'total_not_derived', r.source, r.review_id
            FROM (SELECT *, row_number() OVER (PARTITION BY source, review_id ORDER BY pos) AS rn FROM raw) r
            LEFT JOIN {facts} f ON r.source = f.restaurant_id AND r.review_id = f.review_id
            WHERE rn = 1 AND NOT regexp_matches(r.review_id, '(?i)(_copy|_dup)$') AND r.total_spent IS NULL AND r.tip_amount > 0 AND r.tip_percentage > 0
              AND (f.review_id IS NULL OR (f.transaction_count = 1 AND NOT coalesce(f.total_spent > 0, false)))""",
        f"SELECT 'id_not_unique', restaurant_id, review_id FROM {facts} GROUP BY ALL HAVING count(*) > 1",
    ]
    for c in _PASS:
        parts.append(
            f"""SELECT 'lost_{c}', f.restaurant_id, f.review_id FROM {facts} f JOIN raw r ON r.source = f.restaurant_id AND r.review_id = f.review_id
                WHERE f.transaction_count = 1 AND NOT ({blank(c, 'r')}) AND {blank(c, 'f')}"""
        )
    return " UNION ALL ".join(parts)


# ---- retrieval ----

_INDEX = views.oracle_text(views.INDEX)
_CENTROIDS = """SELECT label AS q_id, list(m ORDER BY i) AS q FROM (
    SELECT label, i, avg(x::DOUBLE) AS m FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)
    GROUP BY label, i) GROUP BY label"""
_TARGETS = """SELECT q_id, q, CASE q_id % 5 WHEN 0 THEN [NULL] WHEN 1 THEN ['r' || (q_id + 1) % 10]
    WHEN 2 THEN ['r' || q_id % 10, 'r' || (q_id + 3) % 10]
    WHEN 3 THEN ['r' || (q_id + 2) % 10, 'r' || (q_id + 5) % 10, 'r' || (q_id + 2) % 10] ELSE ['nowhere'] END AS targets FROM centroids"""
_SEARCHES = """SELECT q_id, q, unnest(targets) AS target, generate_subscripts(targets, 1) - 1 AS target_no,
    len(list_filter(targets, lambda t: t IS NOT NULL)) AS n, CASE WHEN len(targets) > 1 THEN greatest(2, 5 // len(targets)) ELSE 5 END AS k FROM targeted"""
_PRE = """SELECT * FROM (SELECT s.q_id, s.target_no, s.n, s.k, i.review_id, i.restaurant_id, s.score_,
      row_number() OVER (PARTITION BY s.q_id, s.target_no ORDER BY s.score_ DESC, i.review_id) AS rank
    FROM (SELECT s.*, i.review_id AS rid, round(list_inner_product(i.embedding::DOUBLE[], s.q), 9) AS score_ FROM searches s JOIN idx i
      ON s.target IS NULL OR s.target = i.restaurant_id) s JOIN idx i ON s.rid = i.review_id) WHERE rank <= k"""
_CUT = """SELECT * FROM (SELECT *, max(score_) OVER (PARTITION BY q_id) AS top FROM found)
    WHERE fallback OR n > 1 OR top <= 0 OR score_ >= 0.7 * top"""


def _open_ranked(k: int) -> dict[str, str]:
    return {
        "idx": _INDEX, "centroids": _CENTROIDS,
        "scored": "SELECT q_id, review_id, restaurant_id, round(list_inner_product(embedding::DOUBLE[], q), 9) AS score_ FROM centroids, idx",
        "ranked": f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY score_ DESC, review_id) AS rank FROM scored) WHERE rank <= {k}",
    }


def _retrieved() -> dict[str, str]:
    return {
        "idx": _INDEX, "centroids": _CENTROIDS, "targeted": _TARGETS, "searches": _SEARCHES,
        "found": f"SELECT *, false AS fallback FROM ({_PRE})", "kept": _CUT,
    }


def _post_retrieved() -> dict[str, str]:
    return {
        "idx": _INDEX, "centroids": _CENTROIDS, "targeted": _TARGETS, "searches": _SEARCHES,
        "open_ranked": """SELECT * FROM (SELECT s.*, i.review_id, i.restaurant_id, round(list_inner_product(i.embedding::DOUBLE[], s.q), 9) AS score_,
            row_number() OVER (PARTITION BY q_id, target_no ORDER BY round(list_inner_product(i.embedding::DOUBLE[], s.q), 9) DESC, i.review_id) AS rank
            FROM searches s, idx i) WHERE rank <= k AND (target IS NULL OR target = restaurant_id)""",
        "spare": """SELECT * FROM (SELECT s.*, i.review_id, i.restaurant_id, row_number() OVER (PARTITION BY q_id, target_no ORDER BY i.review_id) AS rank
            FROM searches s JOIN idx i ON s.target = i.restaurant_id
            WHERE NOT EXISTS (SELECT 1 FROM open_ranked o WHERE o.q_id = s.q_id AND o.target_no = s.target_no)) WHERE rank <= k""",
        "found": """SELECT q_id, target_no, n, rank, review_id, restaurant_id, score_, false AS fallback FROM open_ranked
            UNION ALL SELECT q_id, target_no, n, rank, review_id, restaurant_id, NULL, true FROM spare""",
        "kept": _CUT,
    }


_HITS = " SELECT q_id, target_no, rank, review_id, restaurant_id, round(score_, 6) AS score, fallback FROM kept"
_EVIDENCE = """SELECT k.q_id, k.target_no, k.rank, k.review_id, '- Restaurant: ' || k.restaurant_id || ' | Rating: ' || coalesce(CAST(i.rating AS VARCHAR), 'n/a')
    || ' | Review: ' || coalesce(d.text, '') AS line FROM kept k JOIN idx i USING (review_id) LEFT JOIN documents d ON CAST(d.doc_id AS VARCHAR) = k.review_id"""
_BLOCKS = r"""SELECT q_id, count(*) AS n_sources, string_agg(line, chr(10) ORDER BY target_no, rank) AS context,
    string_agg(review_id, '|' ORDER BY target_no, rank) AS sources FROM evidence GROUP BY q_id"""

# ---- questions ----

_QUESTIONS = {
    "questions": f"""SELECT q_id, trim(question) AS question, lower(trim(question)) AS text,
        CASE WHEN payload_id <> '' THEN [payload_id] WHEN payload_list <> '' THEN string_split(payload_list, ',') END AS payload
        FROM ({views.oracle_text(views.QUESTIONS_TEXT)})""",
    "valid": "SELECT * FROM questions WHERE question <> ''",
    "entries": f"SELECT name, restaurant_id FROM ({_DICTIONARY}) UNION SELECT lower(location), lower(location) FROM ({_NATIONS})",
}
_FOUND = {
    **_QUESTIONS,
    "found": "SELECT q_id, list_sort(list(DISTINCT restaurant_id)) AS text_targets FROM valid, entries WHERE contains(text, name) GROUP BY q_id",
    "resolved": """SELECT q_id, question,
        CASE WHEN len(t) > 1 THEN 'text' WHEN payload IS NOT NULL THEN 'payload' WHEN len(t) = 1 THEN 'text' ELSE 'none' END AS origin,
        CASE WHEN len(t) > 1 THEN t WHEN payload IS NOT NULL THEN payload ELSE t END AS targets
        FROM (SELECT v.*, coalesce(text_targets, []) AS t FROM valid v LEFT JOIN found USING (q_id))""",
}

# ---- index and evaluation ----

_DOCS = views.oracle_text(views.DOCS)
_KNOWN = views.oracle_text(views.INDEXED_IDS)
_DOC_FIELDS = {
    "docs": _DOCS,
    "typed": f"""SELECT pos, review_id, restaurant_id, CAST({_number('rating')} AS FLOAT) AS rating,
        strftime(try_strptime(nullif(review_date, ''), '%Y-%m-%d'), '%Y-%m-%d') AS review_date, review_text,
        coalesce(regexp_matches(review_text, '[^{_SPACE[1:-1]}]'), false) AS full_text, rating AS raw_rating FROM docs""",
    "known": _KNOWN,
}
_ANSWERS = views.oracle_text(views.ANSWERS)
_REFUSALS = " OR ".join(f"contains(lower(answer), '{p}')" for p in ("not authorized", "cannot calculate", "quantitative questions", "typically say"))
_SCORED = {
    "answers": _ANSWERS,
    "marked": f"""SELECT id, category, answer, list_filter(list_filter(string_split(query, ' '), lambda w, i: list_position(string_split(query, ' '), w) = i), lambda w: contains(lower(answer), lower(w))) AS matched,
        upper(category) IN ('RATINGS', 'CALCULATIONS') AND ({_REFUSALS}) AS refused FROM answers""",
    "scored": """SELECT id, category, replace(answer, chr(10), ' ') AS answer,
        array_to_string(CASE WHEN refused THEN list_append(matched, 'GUARDRAIL_INTERCEPTED') ELSE matched END, '|') AS matched_keywords,
        refused, length(answer) > 0 AND (len(matched) > 0 OR refused) AS passed FROM marked""",
}

_REFRESH = {
    **_DOC_FIELDS,
    "first": """SELECT review_id, review_text FROM (SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY pos) AS rn FROM typed
        WHERE review_id <> '' AND full_text) WHERE rn = 1""",
    "edited": "SELECT review_id, review_text, CASE WHEN right(review_id, 1) IN ('1', '4', '7') THEN review_text || CASE WHEN right(review_id, 1) = '4' THEN ' edited?' ELSE ' edited!' END ELSE review_text END AS text FROM first",
}
# Divisors of a stream whose config changes after its first two sources.
_CHANGED = "CASE WHEN source IN ('north', 'south') THEN 2 ELSE 1 END"
_LAKE_COLUMNS = (
    "review_id", "customer_id", "review_date", "rating", "review_text", "total_spent", "tip_amount", "tip_percentage", "party_size", "age_range", "gender", "ethnicity",
)
_CONTRACT_ROWS = " UNION ALL ".join(
    f"SELECT '{name}' AS check_id, '{dataset}' AS dataset, 0::BIGINT AS n_bad, '' AS sample_ids"
    for name, dataset in (
        ("facts_schema", "facts"), ("facts_column_order", "facts"), ("reference_schema", "reference"), ("reference_column_order", "reference"),
    )
)
_LONE = """SELECT coalesce(f.id, d.id) AS restaurant_id, f.id IS NOT NULL AS in_facts, d.id IS NOT NULL AS in_reference
    FROM (SELECT DISTINCT lower(restaurant_id) AS id FROM facts) f FULL JOIN (SELECT DISTINCT restaurant_id AS id FROM dimension) d ON f.id = d.id
    WHERE f.id IS NULL OR d.id IS NULL"""

# ---- hashed words ----

_32 = "4294967295::UBIGINT"


def _times(value: str, by: int) -> str:
    return f"(({value}) * {by}::UBIGINT) & {_32}"


def _turned(value: str, bits: int) -> str:
    return f"((({value}) << {bits}) | (({value}) >> {32 - bits})) & {_32}"


def _byte(at: str) -> str:
    return f"substr(h, (2 * ({at}) + 1)::BIGINT, 2)"


def _hashed(tokens: str) -> dict[str, str]:
    """CTEs from ``tokens`` (id, word) to ``vectors`` (id, slot, weight): Murmur3 of every word, by the book."""
    each = "list_transform(blocks, lambda k: {})"
    steps = {}
    for number, step in enumerate((_times("k", 3432918353), _turned("k", 15), _times("k", 461845907))):
        steps[f"stirred{number}"] = (
            f"SELECT word, n, {each.format(step)} AS blocks, {step.replace('k', 'tail')} AS tail FROM {f'stirred{number - 1}' if number else 'cut'}")
    folded = _turned("xor(a, k)", 13)
    return {
        "tokens": tokens,
        "coded": "SELECT word, hex(encode(word)) AS h, octet_length(encode(word))::UBIGINT AS n FROM (SELECT DISTINCT word FROM tokens)",
        "cut": f"""SELECT word, n, list_transform(range(0, (n // 4)::BIGINT),
              lambda i: ('0x' || {_byte('4 * i + 3')} || {_byte('4 * i + 2')} || {_byte('4 * i + 1')} || {_byte('4 * i')})::UBIGINT) AS blocks,
            CASE n % 4 WHEN 0 THEN 0::UBIGINT WHEN 1 THEN ('0x' || {_byte('n - 1')})::UBIGINT WHEN 2 THEN ('0x' || {_byte('n - 1')} || {_byte('n - 2')})::UBIGINT
              ELSE ('0x' || {_byte('n - 1')} || {_byte('n - 2')} || {_byte('n - 3')})::UBIGINT END AS tail FROM coded""",
        **steps,
        "folded": f"SELECT word, n, xor(xor(list_reduce(blocks, lambda a, k: (({folded}) * 5::UBIGINT + 3864292196::UBIGINT) & {_32}, 42::UBIGINT), tail), n) AS a FROM stirred2",
        "mixed1": f"SELECT word, {_times('xor(a, a >> 16)', 2246822507)} AS a FROM folded",
        "mixed2": f"SELECT word, {_times('xor(a, a >> 13)', 3266489909)} AS a FROM mixed1",
        "slots": "SELECT word, (xor(a, a >> 16) % 1024)::INTEGER AS slot FROM mixed2",
        "counts": "SELECT id, slot, count(*)::DOUBLE AS n FROM tokens JOIN slots USING (word) GROUP BY id, slot",
        "vectors": "SELECT id, slot, (n / sqrt(sum(n * n) OVER (PARTITION BY id)))::FLOAT::DOUBLE AS weight FROM counts",
    }


_WORDS = r"unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS word"
_ASKED_SOURCES = {
    "questions": "SELECT n_nationkey::BIGINT AS q_id, 'What about src' || n_nationkey || ' and the waiting?' AS question, n_nationkey % 5 = 0 AS paid FROM nation",
    "resolved": """SELECT q_id, question, CASE WHEN paid AND len(named) < 2 THEN ['src0'] ELSE named END AS targets FROM (
        SELECT q_id, question, paid, list_sort(list(DISTINCT source) FILTER (contains(question, source))) AS named
        FROM questions, (SELECT DISTINCT source FROM documents) GROUP BY ALL)""",
    "searches": """SELECT q_id, unnest(targets) AS target, generate_subscripts(targets, 1) - 1 AS target_no, len(targets) AS n,
        CASE WHEN len(targets) > 1 THEN greatest(2, 5 // len(targets)) ELSE 5 END AS k FROM resolved""",
}

SQL: dict[str, str] = {
    "near_dup_drop": _with(raw=RAW) + f"""
        SELECT r.source, r.review_id, r.pos, coalesce(n.n, 0) AS near_dup_count FROM raw r
        LEFT JOIN (SELECT source, {_BASE} AS base, count(*) AS n FROM raw WHERE {_NEAR} GROUP BY ALL) n ON r.source = n.source AND r.review_id = n.base
        WHERE NOT {_NEAR.replace('review_id', 'r.review_id')}""",
    "near_dup_orphans": _with(raw=RAW) + f"""
        SELECT source, {_BASE} AS review_id, count(*) AS orphan_rows FROM raw r WHERE {_NEAR} AND NOT EXISTS (
          SELECT 1 FROM raw b WHERE b.source = r.source AND b.review_id = {_BASE.replace('review_id', 'r.review_id')}
          AND NOT {_NEAR.replace('review_id', 'b.review_id')}) GROUP BY ALL""",
    "near_dup_check": _with(raw=RAW) + f" SELECT source, count(*) FILTER ({_NEAR}) AS near_dups FROM raw GROUP BY source",
    "collapse_duplicates": _with(
        raw=RAW, nears=f"SELECT source, {_BASE} AS review_id, count(*) AS n FROM raw WHERE {_NEAR} GROUP BY ALL",
        sized=f"""SELECT r.*, count(*) OVER (PARTITION BY r.source, r.review_id) + coalesce(n, 0) AS transaction_count,
            row_number() OVER (PARTITION BY r.source, r.review_id ORDER BY pos) AS rn
            FROM (SELECT * FROM raw WHERE NOT {_NEAR}) r LEFT JOIN nears USING (source, review_id)""",
    ) + """
        SELECT source, review_id, arg_min(review_date, pos) FILTER (review_date IS NOT NULL) AS review_date,
          arg_min(rating, pos) FILTER (rating IS NOT NULL) AS rating, arg_min(review_text, pos) FILTER (review_text IS NOT NULL) AS review_text,
          """ + ", ".join(
              f"max({c}) FILTER (transaction_count = 1) AS {c}"
              for c in ("customer_id", "total_spent", "tip_amount", "tip_percentage", "party_size", "age_range", "gender", "ethnicity")
          ) + ", max(transaction_count) AS transaction_count FROM sized GROUP BY source, review_id",
    "keep_first": _with(raw=RAW) + """
        SELECT source, review_id, pos, customer_id, rating FROM
        (SELECT *, row_number() OVER (PARTITION BY source, review_id ORDER BY pos) AS rn FROM raw) WHERE rn = 1""",
    "date_normalize": _with(raw=RAW) + f" SELECT pos, review_date AS raw_date, strftime({_date('review_date')}, '%Y-%m-%d') AS review_date FROM raw",
    "date_audit": _with(raw=RAW) + f"""
        SELECT source, count(*) FILTER (review_date IS NOT NULL AND {_date('review_date')} IS NULL) AS unparseable,
          count(*) FILTER (review_date IS NULL) AS missing,
          count(*) FILTER (regexp_full_match(review_date, '\\d{{4}}-\\d{{2}}-\\d{{2}}') AND try_strptime(review_date, '%Y-%m-%d') IS NOT NULL) AS iso
        FROM raw GROUP BY source""",
    "rating_normalize": _with(raw=RAW) + f" SELECT pos, rating AS raw_rating, {_rating('rating')} AS rating FROM raw",
    "rating_outcomes": _with(raw=RAW) + f" SELECT source, {_outcome('rating')} AS outcome, count(*) AS n_rows FROM raw GROUP BY ALL",
    "rating_symbols": _with(raw=RAW) + f"""
        SELECT source, array_to_string(list_sort(list(DISTINCT symbol)), '') AS symbols FROM (
          SELECT source, unnest(regexp_extract_all(regexp_replace(rating, '{_NON_SYMBOL}', '', 'g'), '.')) AS symbol
          FROM raw WHERE {_outcome('rating')} = 'symbol') GROUP BY source""",
    "derive_total": _with(raw=RAW) + f" SELECT pos, tip_amount, tip_percentage, {_TOTAL} AS total_spent FROM raw WHERE {_NEEDS_TOTAL}",
    "fact_standardize": _facts_text(False),
    "fact_standardize_compat": _facts_text(True),
    "header_union": _with(raw=RAW) + """
        SELECT source, pos, review_id, customer_id, review_date, review_text, CASE WHEN source <> 'south' THEN tip_percentage END AS tip_percentage FROM raw""",
    "source_routing": _with(
        keys=views.oracle_text(views.KEYS), decoded="SELECT doc_id, url_decode(replace(key, '+', ' ')) AS file_key FROM keys",
        names="SELECT DISTINCT source FROM documents",
        matched="SELECT d.doc_id, arg_max(n.source, length(n.source)) AS source FROM decoded d, names n WHERE contains(lower(file_key), n.source) GROUP BY d.doc_id",
        kinds="""SELECT d.doc_id, d.file_key, m.source, CASE WHEN NOT starts_with(file_key, 'raw/') THEN 'skipped'
            WHEN regexp_matches(lower(file_key), 'restaurant_info|reference') THEN 'dimension' WHEN m.source IS NOT NULL THEN 'fact' ELSE 'quarantine' END AS kind
            FROM decoded d LEFT JOIN matched m USING (doc_id)""",
    ) + r"""
        SELECT doc_id, file_key, CASE WHEN kind = 'fact' THEN source END AS source, kind,
          CASE WHEN kind IN ('fact', 'dimension') THEN regexp_replace(replace(file_key, 'raw/', 'processed/'), '\.\w+$', '.csv') END AS target_key
        FROM kinds""",
    "source_routing_many": _with(keys=views.oracle_text(views.MANY_KEYS)) + """
        SELECT k.doc_id, arg_max(n.source, length(n.source)) AS source, 'fact' AS kind FROM keys k JOIN keys n ON contains(lower(k.key), n.source) GROUP BY k.doc_id""",
    "config_headers": _with(config=views.oracle_text(views.MAPPING_CONFIG)) + """
        SELECT lower(source_dataset) AS source, input_column, arg_max(target_column, pos) AS target_column FROM config c
        WHERE source_dataset = (SELECT max(source_dataset) FROM config d WHERE lower(d.source_dataset) = lower(c.source_dataset)) GROUP BY ALL""",
    "document_names": r"""
        WITH names AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{6,}')) AS name FROM benchmark),
        words AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS name FROM documents)
        SELECT name, count(*) AS documents FROM words JOIN names USING (name) GROUP BY name""",
    "config_divisors": _with(config=views.oracle_text(views.MAPPING_CONFIG)) + """
        SELECT lower(source_dataset) AS source, coalesce(CAST(trunc(arg_min(rating_divisor, pos) FILTER (rating_divisor IS NOT NULL)) AS INTEGER), 1) AS divisor,
          count(DISTINCT rating_divisor) AS n_distinct FROM config c
        WHERE source_dataset = (SELECT max(source_dataset) FROM config d WHERE lower(d.source_dataset) = lower(c.source_dataset)) GROUP BY source_dataset""",
    "dimension_standardize": _with(**_DIMENSION) + " SELECT * REPLACE (array_to_string(categories, '|') AS categories) FROM dimension",
    "category_counts": f"SELECT category, count(*) AS restaurants FROM (SELECT trim(unnest(string_split(categories, ','))) AS category FROM ({_NATIONS})) GROUP BY category",
    "dictionary": _DICTIONARY,
    "id_encoding_audit": f"""
        SELECT {_lenient('id')} AS lenient, {_strict('id')} AS strict, {_lenient('id')} AND id <> '' AS lenient_non_empty, count(*) AS words
        FROM (SELECT unnest(string_split_regex(text, '[ \\t\\n\\x0B\\f\\r]')) AS id FROM documents) GROUP BY ALL""",
    "id_encoding_samples": _with(raw=RAW) + f"""
        SELECT source, count(*) AS n_bad, array_to_string(list_sort(list(review_id))[1:10], '|') AS sample_ids
        FROM raw WHERE NOT {_strict('review_id')} GROUP BY source""",
    "dq_row_checks": _with(
        raw=RAW, rough="""SELECT * REPLACE (TRY_CAST(trim(rating) AS DOUBLE) AS rating), pos % 3 + 1 AS transaction_count,
            CASE WHEN pos % 17 = 0 THEN 'elsewhere' WHEN pos % 19 <> 0 THEN source END AS restaurant_id FROM raw""",
    ) + _sampled(_row_failures(
        "rough", "NOT coalesce(regexp_full_match(review_date, '\\d{4}-\\d{2}-\\d{2}') AND try_strptime(review_date, '%Y-%m-%d') IS NOT NULL, false)", "source"
    )),
    "dq_passthrough": _with(
        **_facts(), damaged="""SELECT * REPLACE (CASE WHEN restaurant_id <> 'north' THEN review_text END AS review_text,
            CASE WHEN restaurant_id <> 'south' THEN total_spent END AS total_spent, CASE WHEN restaurant_id <> 'east' THEN rating END AS rating) FROM facts""",
    ) + _sampled(_id_failures("damaged")),
    "dq_summary": _with(**_facts(), **_DIMENSION, lone=_LONE) + f"""
        {_sampled(_row_failures('facts', 'review_date IS NULL') + ' UNION ALL ' + _id_failures('facts'))}
        UNION ALL SELECT CASE WHEN in_facts THEN 'restaurant_not_in_reference' ELSE 'restaurant_without_facts' END, 'all', count(*),
          array_to_string(list_sort(list(restaurant_id))[1:25], '|') FROM lone GROUP BY 1
        UNION ALL SELECT 'reference_null_id', 'reference', count(*) FILTER (restaurant_id IS NULL), '' FROM dimension
        UNION ALL {_CONTRACT_ROWS}""",
    "dq_cross_ids": _with(**_facts(), **_DIMENSION) + _LONE,
    "dq_reconcile": _with(
        **_facts(), weights="SELECT restaurant_id AS dataset, sum(transaction_count) AS w FROM facts GROUP BY 1",
        totals="SELECT source AS dataset, count(*) AS n, count(*) FILTER (review_id IS NULL) AS q FROM raw GROUP BY 1",
        orphans=f"""SELECT source AS dataset, count(*) AS o FROM raw r WHERE {_NEAR} AND NOT EXISTS (SELECT 1 FROM sized s
            WHERE s.source = r.source AND s.review_id = {_BASE.replace('review_id', 'r.review_id')}) GROUP BY 1""",
    ) + """
        SELECT dataset, n::BIGINT AS raw_rows, w::BIGINT AS weighted_rows, coalesce(o, 0)::BIGINT AS orphan_rows, q::BIGINT AS quarantined_rows,
          (n - w)::BIGINT AS difference, (n - w - coalesce(o, 0) - q)::BIGINT AS unexplained
        FROM totals JOIN weights USING (dataset) LEFT JOIN orphans USING (dataset)""",
    "profile_fanout": _with(raw=RAW) + """
        SELECT source, rows_per_id, count(*) AS ids, """ + ", ".join(
            f"count(*) FILTER (d_{c} > 1) AS conflict_{c}" for c in ("customer_id", "party_size", "total_spent", "review_text")
        ) + " FROM (SELECT source, review_id, count(*) AS rows_per_id, " + ", ".join(
            f"count(DISTINCT {c}) AS d_{c}" for c in ("customer_id", "party_size", "total_spent", "review_text")
        ) + " FROM raw GROUP BY source, review_id) GROUP BY source, rows_per_id",
    "profile_tips": _with(raw=RAW) + """
        SELECT source, count(*) AS n_rows, count(total_spent) FILTER (total_spent <> 0) AS comparable,
          count(*) FILTER (total_spent <> 0 AND abs(tip_amount / total_spent * 100 - tip_percentage) < 0.1) AS consistent,
          round(avg((tip_percentage > 20)::INT), 6) AS over_20_share, round(avg((tip_amount = 0)::INT), 6) AS zero_tip_share
        FROM raw GROUP BY source""",
    "profile_domain_gaps": _with(raw=RAW) + """
        SELECT source, CAST(i AS INTEGER) AS party_size FROM (SELECT DISTINCT source FROM raw) s, range(1, 13) t(i)
        WHERE NOT EXISTS (SELECT 1 FROM raw r WHERE r.source = s.source AND r.party_size = i)""",
    "profile_spend": _with(raw=RAW, heads="SELECT source, total_spent / party_size AS p FROM raw WHERE party_size > 0 AND total_spent IS NOT NULL") + """
        SELECT source, count(*) AS n_rows, round(min(p), 4) AS lowest, round(quantile_disc(p, 0.5), 4) AS median, round(quantile_disc(p, 0.99), 4) AS p99,
          count(*) FILTER (p < 1.5) AS below_limit FROM heads GROUP BY source""",
    "profile_overlap": _with(raw=RAW) + """
        SELECT split_part(customer_id, '_', 1) AS prefix, restaurants, count(*) AS customers, sum(visits)::BIGINT AS visits FROM
        (SELECT customer_id, count(DISTINCT source) AS restaurants, count(*) AS visits FROM raw GROUP BY customer_id) GROUP BY ALL""",
    "profile_cents": _with(
        raw=RAW, endings="SELECT source, CAST(CAST(total_spent AS DECIMAL(18,2)) * 100 AS BIGINT) % 100 AS cents, count(*) AS n FROM raw WHERE total_spent IS NOT NULL GROUP BY ALL",
        totals="SELECT source, sum(n) AS total FROM endings GROUP BY source",
    ) + """
        SELECT t.source, max(total)::BIGINT AS n_rows, count(n) AS endings,
          round(sum(power(coalesce(n, 0) - total / 100.0, 2) / (total / 100.0)), 4) AS chi_square
        FROM (SELECT * FROM totals, range(0, 100) r(c)) t LEFT JOIN endings e ON e.source = t.source AND e.cents = t.c GROUP BY t.source""",
    "profile_text_length": _with(docs=_DOCS) + """
        SELECT restaurant_id, count(review_text) AS texts, count(*) FILTER (length(review_text) > 2000) AS over_limit,
          round(avg((length(review_text) > 2000)::INT), 6) AS over_limit_share, max(length(review_text))::INT AS longest FROM docs GROUP BY restaurant_id""",
    "restaurant_summary": _with(**_facts(), **_DIMENSION) + """
        SELECT d.restaurant_id, any_value(restaurant_name) AS restaurant_name, round(avg(rating), 6) AS avg_rating, count(review_id) AS reviews,
          count(rating) AS rated, coalesce(sum(transaction_count), 0)::BIGINT AS submissions
        FROM dimension d LEFT JOIN facts f ON d.restaurant_id = f.restaurant_id GROUP BY d.restaurant_id""",
    "docs_per_restaurant": _with(idx=_INDEX) + """
        SELECT 'total' AS scope, NULL::VARCHAR AS restaurant_id, count(*) AS docs FROM idx UNION ALL
        (SELECT 'restaurant', restaurant_id, count(*) AS docs FROM idx GROUP BY restaurant_id ORDER BY docs DESC, restaurant_id LIMIT 10)""",
    "knn_topk": _with(**_open_ranked(5)) + " SELECT q_id, rank, review_id, restaurant_id, round(score_, 6) AS score FROM ranked",
    "knn_cutoff": _with(**_open_ranked(20)) + """
        SELECT q_id, rank, review_id, round(score_, 6) AS score FROM (SELECT *, max(score_) OVER (PARTITION BY q_id) AS top FROM ranked)
        WHERE top <= 0 OR score_ >= 0.7 * top""",
    "knn_filtered": _with(idx=_INDEX, centroids=_CENTROIDS) + """
        SELECT q_id, asked, rank, review_id, round(score_, 6) AS score FROM (
          SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY score_ DESC, review_id) AS rank FROM (
            SELECT q_id, 'r' || (q_id + 1) % 10 AS asked, review_id, round(list_inner_product(embedding::DOUBLE[], q), 9) AS score_
            FROM centroids JOIN idx ON restaurant_id = 'r' || (q_id + 1) % 10)) WHERE rank <= 5""",
    "knn_balanced": _with(**_retrieved()) + _HITS,
    "knn_sliced": _with(**_retrieved()) + _HITS,
    "knn_fallback": _with(**_post_retrieved()) + _HITS,
    "question_targets": _with(**_FOUND) + " SELECT q_id, array_to_string(text_targets, '|') AS text_targets FROM found",
    "question_targets_word": _with(**_QUESTIONS) + r"""
        SELECT q_id, array_to_string(list_sort(list(DISTINCT restaurant_id)), '|') AS text_targets FROM valid, entries
        WHERE contains(' ' || regexp_replace(text, '[^\p{L}\p{N}_]', ' ', 'g') || ' ', ' ' || name || ' ') GROUP BY q_id""",
    "question_resolution": _with(**_FOUND) + " SELECT q_id, question, origin, array_to_string(targets, '|') AS targets FROM resolved",
    "question_rejected": _with(**_QUESTIONS) + """ SELECT q_id, question, 'Missing "question" in request body.' AS error FROM questions WHERE question = ''""",
    "question_unknown_targets": _with(**_FOUND) + f"""
        SELECT DISTINCT q_id, target FROM (SELECT q_id, unnest(targets) AS target FROM resolved)
        WHERE lower(target) NOT IN (SELECT lower(location) FROM ({_NATIONS}))""",
    "context_blocks": _with(**_retrieved(), evidence=_EVIDENCE, blocks=_BLOCKS) + " SELECT q_id, n_sources, context FROM blocks",
    "evidence_files": _with(**_retrieved()) + """
        SELECT q_id, target_no, rank, review_id, md5(text) AS text_md5 FROM kept LEFT JOIN documents ON CAST(doc_id AS VARCHAR) = review_id""",
    "answer_payloads": _with(**_retrieved(), evidence=_EVIDENCE, blocks=_BLOCKS) + """
        SELECT c.q_id, 'Use only these reviews.' || chr(10) || context || chr(10) || chr(10) || 'Asked: Question ' || c.q_id || chr(10) || 'Reply:' AS prompt,
          CASE WHEN b.q_id IS NULL THEN 'I couldn''t find any relevant reviews to answer that question.' END AS answer, coalesce(sources, '') AS sources
        FROM centroids c LEFT JOIN blocks b ON c.q_id = b.q_id""",
    "text_chunks": """
        SELECT review_id, CAST(i AS INTEGER) AS chunk_no, substr(text, i * 2000 + 1, 2000) AS chunk
        FROM (SELECT doc_id AS review_id, text, unnest(range(0, (length(text) + 1999) // 2000)) AS i FROM documents)""",
    "index_documents": _with(**_DOC_FIELDS) + " SELECT pos, review_id, restaurant_id, rating, review_date FROM typed",
    "index_increment": _with(**_DOC_FIELDS) + """
        SELECT review_id, restaurant_id, rating, review_date, review_text FROM
        (SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY pos) AS rn FROM typed WHERE review_id <> '' AND full_text) t
        WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM known k WHERE k.review_id = t.review_id)""",
    "index_counts": _with(
        **_DOC_FIELDS, usable="SELECT t.*, EXISTS (SELECT 1 FROM known k WHERE k.review_id = t.review_id) AS was_known FROM typed t WHERE review_id <> ''",
        staged="""SELECT *, coalesce(max(full_text::INT) OVER (PARTITION BY review_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1
            AS earlier FROM usable""",
    ) + f"""
        SELECT count(*) FILTER (NOT was_known AND NOT earlier AND full_text) AS indexed, count(*) FILTER (was_known OR earlier) AS skipped,
          count(*) FILTER (NOT was_known AND NOT earlier AND NOT full_text) AS blank,
          (SELECT count(*) FROM typed WHERE review_id IS NULL OR review_id = '') AS missing_id,
          (SELECT count(*) FROM typed WHERE raw_rating NOT IN ('', 'nan') AND rating IS NULL) AS bad_rating FROM staged""",
    "stream_ingest": _facts_text(False),
    "stream_config": _with(**_facts()).replace(" / 2, 1)", f" / {_CHANGED}, 1)") + f"""
        SELECT restaurant_id, review_id, rating, {_CHANGED.replace('source', 'restaurant_id')}::DOUBLE AS divisor FROM facts""",
    "stream_ledger": _with(raw=RAW) + " SELECT DISTINCT 'fact' AS kind, source, 'loaded' AS status, 1 AS versions, true AS held FROM raw",
    "stream_index": _with(**_facts()) + f"""
        SELECT review_id, restaurant_id, CAST(rating AS FLOAT) AS rating, strftime(review_date, '%Y-%m-%d') AS review_date, review_text
        FROM facts WHERE NOT ({_blank_text('review_text')})""",
    "hash_embed": _with(**_hashed(f"SELECT doc_id AS id, {_WORDS} FROM documents")) + " SELECT id AS doc_id, slot, weight FROM vectors",
    "hash_retrieve": _with(
        **_hashed(f"SELECT 'd' || doc_id AS id, {_WORDS} FROM documents UNION ALL SELECT 'q' || item_id, {_WORDS} FROM benchmark"),
        scored="""SELECT q.id AS q, d.id AS d, round(sum(q.weight * d.weight), 9) AS score_ FROM vectors q JOIN vectors d USING (slot)
            WHERE q.id LIKE 'q%' AND d.id LIKE 'd%' GROUP BY q.id, d.id""",
        ranked="""SELECT *, row_number() OVER (PARTITION BY q ORDER BY score_ DESC, d) AS rank, max(score_) OVER (PARTITION BY q) AS top FROM scored""",
    ) + """
        SELECT substr(q, 2)::BIGINT AS q_id, rank::INTEGER AS rank, substr(d, 2) AS review_id, source AS restaurant_id, round(score_, 6) AS score
        FROM ranked JOIN documents ON 'd' || doc_id = d WHERE rank <= 5 AND score_ >= 0.7 * top""",
    "question_answers": _with(
        **_ASKED_SOURCES,
        **_hashed(f"SELECT 'd' || doc_id AS id, {_WORDS} FROM documents UNION ALL SELECT 'q' || q_id, {_WORDS.replace('text', 'question')} FROM questions"),
        scored="""SELECT q.id AS q, d.id AS d, round(sum(q.weight * d.weight), 9) AS score_ FROM vectors q JOIN vectors d USING (slot)
            WHERE q.id LIKE 'q%' AND d.id LIKE 'd%' GROUP BY q.id, d.id""",
        pairs="""SELECT s.*, doc_id::VARCHAR AS review_id, text, coalesce(score_, 0) AS score_ FROM searches s JOIN documents ON source = target
            LEFT JOIN scored ON q = 'q' || q_id AND d = 'd' || doc_id""",
        ranked="SELECT *, row_number() OVER (PARTITION BY q_id, target_no ORDER BY score_ DESC, review_id) AS rank FROM pairs",
        found="SELECT *, max(score_) OVER (PARTITION BY q_id) AS top FROM ranked WHERE rank <= k",
        blocks="""SELECT q_id, string_agg('- Restaurant: ' || target || ' | Rating: n/a | Review: ' || text, chr(10) ORDER BY target_no, rank) AS context,
            string_agg(review_id, '|' ORDER BY target_no, rank) AS sources FROM found WHERE n > 1 OR top <= 0 OR score_ >= 0.7 * top GROUP BY q_id""",
    ) + """
        SELECT q_id, md5('Use only these reviews.' || chr(10) || context || chr(10) || chr(10) || 'Asked: ' || question || chr(10) || 'Reply:') AS prompt_md5,
          CASE WHEN context IS NULL THEN 'I couldn''t find any relevant reviews to answer that question.' END AS answer,
          coalesce(sources, '') AS sources, NULL::VARCHAR AS error
        FROM questions LEFT JOIN blocks USING (q_id)""",
    "index_refresh": _with(**_REFRESH) + " SELECT review_id, md5(CASE WHEN text LIKE '%?' AND text <> review_text THEN review_text ELSE text END) AS text_md5 FROM edited",
    "index_versions": _with(**_REFRESH) + """
        SELECT 1 AS version, review_id, md5(review_text) AS text_md5 FROM edited WHERE review_text NOT LIKE '%?' UNION ALL
        SELECT 2, review_id, md5(CASE WHEN text LIKE '%?' THEN review_text ELSE text END) FROM edited WHERE review_text NOT LIKE '%?' OR text NOT LIKE '%?'""",
    "index_failures": _with(**_REFRESH) + " SELECT review_id, md5(text) AS text_md5 FROM edited WHERE text LIKE '%?' AND text <> review_text",
    "stream_quarantine": _with(raw=RAW) + " SELECT DISTINCT source AS folder, true AS held FROM raw WHERE source = 'west'",
    "lake_ingest": _facts_text(False),
    "lake_config": _with(raw=RAW) + f"""
        SELECT source AS source_dataset, c AS input_column, c AS target_column, CASE WHEN c = 'rating' THEN 2::DOUBLE END AS rating_divisor
        FROM (SELECT DISTINCT source FROM raw), (SELECT unnest({list(_LAKE_COLUMNS)}) AS c)""",
    "csv_export": _with(**_DIMENSION) + """
        SELECT restaurant_id, restaurant_name, '[' || array_to_string(list_transform(categories, lambda c: '"' || c || '"'), ', ') || ']' AS categories FROM dimension""",
    "cases_file": _with(answers=_ANSWERS) + """
        SELECT id::VARCHAR AS id, category, md5(query) AS query_md5, len(list_distinct(string_split(query, ' '))) AS keywords FROM answers""",
    "result_tables": _with(**_SCORED) + """
        SELECT run, category, count(*) AS tests, count(*) FILTER (passed) AS passed, round(avg(passed::INT) * 100, 1) AS pass_rate
        FROM scored, (SELECT unnest(['first', 'second']) AS run) WHERE run = 'first' OR category = 'ratings' GROUP BY run, category""",
    "dimension_stream": _with(**_DIMENSION) + " SELECT * REPLACE (array_to_string(categories, '|') AS categories) FROM dimension",
    "eval_keywords": _with(**_SCORED) + " SELECT * FROM scored",
    "eval_summary": _with(**_SCORED) + """
        SELECT category, count(*) AS tests, count(*) FILTER (passed) AS passed, round(avg(passed::INT) * 100, 1) AS pass_rate FROM scored GROUP BY category""",
    "eval_latency": _with(answers=_ANSWERS) + """
        SELECT count(*) AS answers, round(quantile_cont(latency, 0.95), 4) AS p95, round(avg(latency), 4) AS mean,
          round(avg((latency <= 3)::INT), 6) AS within_target FROM answers""",
}

_REPLACED = "NOT (length(review_id) % 4 = 1 AND transaction_count <> 1)"
SQL |= {
    # The same rows by another way.
    "knn_clusters": SQL["knn_topk"],
    "dq_incremental": SQL["dq_passthrough"],
    "counts_running": SQL["index_counts"],
    "summary_running": SQL["restaurant_summary"].replace("LEFT JOIN facts f", f"LEFT JOIN (SELECT * FROM facts WHERE {_REPLACED}) f"),
    "docs_running": _with(**_facts(), held=f"SELECT * FROM facts WHERE {_REPLACED}") + """
        SELECT 'total' AS scope, NULL::VARCHAR AS restaurant_id, count(*) AS docs FROM held UNION ALL
        (SELECT 'restaurant', restaurant_id, count(*) AS docs FROM held GROUP BY restaurant_id ORDER BY docs DESC, restaurant_id LIMIT 10)""",
}
