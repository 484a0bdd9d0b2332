"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from tillflow.llm import licences, url_filter


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def licence_scan() -> str:
    """Sentences joined to the known ones, then one step for each rule over the sequence that is left."""
    known = ", ".join(f"({_text(s)}, {_text(i)})" for s, i in licences.SENTENCES.items())
    steps, before = [], "sequences"
    for n, (name, ids) in enumerate(licences.RULES):
        rule = _text(licences.sequence(ids))
        steps.append(
            f"step{n} AS (SELECT row, ids, replace(rest, {rule}, '{licences.TAKEN}') AS rest, "
            f"CASE WHEN contains(rest, {rule}) THEN list_append(names, {_text(name)}) ELSE names END AS names FROM {before})"
        )
        before = f"step{n}"
    return f"""
      WITH known(sentence, id) AS (VALUES {known}),
      docs AS (SELECT doc_id, row_number() OVER () AS row, string_split_regex(lower(text), {_text(licences.SENTENCE_END)}) AS parts FROM documents),
      cut AS (SELECT row, unnest(parts) AS part, generate_subscripts(parts, 1) AS place FROM docs),
      found AS (SELECT row, place, id FROM cut JOIN known ON sentence = trim(regexp_replace(part, {_text(licences.NOT_NORMAL)}, ' ', 'g'))),
      sequences AS (SELECT row, list(id ORDER BY place) AS ids, string_agg('<' || id || '>', '' ORDER BY place) AS rest,
                           CAST([] AS VARCHAR[]) AS names FROM found GROUP BY row),
      {", ".join(steps)}
      SELECT doc_id, CAST(COALESCE(len(ids), 0) AS BIGINT) AS n_sentences, COALESCE(array_to_string(ids, ','), '') AS sentences,
             COALESCE(array_to_string(list_sort(list_distinct(names)), ','), '') AS licences, COALESCE(replace(rest, '{licences.TAKEN}', ''), '') AS unmatched
      FROM docs LEFT JOIN {before} USING (row)"""


def _host(url: str) -> str:
    found = f"regexp_extract({url}, '(?s)^.*?://([^/?#]*)', 1)"
    return f"COALESCE(translate({found}, '{url_filter.UPPER}', '{url_filter.LOWER}'), '')"


def _path(url: str) -> str:
    return f"COALESCE(regexp_extract({url}, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '')"


def _place(url: str) -> str:
    query = rf"regexp_extract({url}, '(?s)^[^?#]*(\?[^#]*)', 1)"
    return f"CASE WHEN {_host(url)} <> '' THEN {_host(url)} || regexp_replace({_path(url)}, '^$', '/') || {query} END"


def _resolved(base: str, target: str) -> str:
    scheme = f"regexp_extract({base}, '(?s)^(.*?)://', 1)"
    root = f"{scheme} || '://' || {_host(base)}"
    folder = f"regexp_replace(regexp_replace({_path(base)}, '^$', '/'), '[^/]*$', '')"
    return (
        f"CASE WHEN contains({target}, '://') THEN {target} WHEN starts_with({target}, '//') THEN {scheme} || ':' || {target} "
        f"WHEN starts_with({target}, '/') THEN {root} || {target} ELSE {root} || {folder} || {target} END"
    )


def judged_urls() -> str:
    """Rules by suffix and prefix; aliases by a recursive walk over the links."""
    rules = ", ".join(f"({_text(h)}, {_text(p)}, {_text(h + p)}, {_text(v)})" for h, p, v in url_filter.RULES)
    patterns = (*url_filter.CANONICAL, *url_filter.REFRESH)
    targets = "list_concat(" * (len(patterns) - 1) + f"regexp_extract_all(html, {_text(patterns[0])}, 1)"
    targets += "".join(f", regexp_extract_all(html, {_text(p)}, 1))" for p in patterns[1:])
    return f"""
      WITH RECURSIVE rules(rule_host, rule_path, rule, verdict) AS (VALUES {rules}),
      named AS (SELECT url, replace(unnest({targets}), '&amp;', '&') AS target FROM pages WHERE {_host("url")} <> '' AND html IS NOT NULL),
      links AS (SELECT DISTINCT url AS source, {_resolved("url", "target")} AS target FROM named),
      ends AS (SELECT source AS url FROM links UNION SELECT target FROM links),
      edges AS (SELECT {_place("source")} AS a, {_place("target")} AS b FROM links),
      walk(a, b) AS (
        SELECT a, a FROM (SELECT a FROM edges UNION SELECT b FROM edges) AS nodes WHERE a IS NOT NULL
        UNION SELECT walk.a, both_ways.b FROM walk JOIN (SELECT a, b FROM edges UNION SELECT b, a FROM edges) AS both_ways ON walk.b = both_ways.a
        WHERE both_ways.b IS NOT NULL),
      addresses AS (SELECT {_host("url")} AS host, {_path("url")} AS path FROM pages UNION SELECT {_host("url")}, {_path("url")} FROM ends),
      decided AS (SELECT host, path, rule, verdict FROM addresses JOIN rules
        ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
        QUALIFY row_number() OVER (PARTITION BY host, path ORDER BY length(rule) DESC, rule DESC) = 1),
      shared AS (SELECT walk.a AS place, min(verdict) AS verdict FROM walk
        JOIN (SELECT {_place("url")} AS place, {_host("url")} AS host, {_path("url")} AS path FROM ends) AS members ON walk.b = members.place
        JOIN decided USING (host, path) GROUP BY walk.a),
      own AS (SELECT page_id, {_host("url")} AS host, {_path("url")} AS path, {_place("url")} AS place FROM pages)
      SELECT page_id, own.host, own.path, rule, COALESCE(decided.verdict, shared.verdict, 'allow') AS verdict
      FROM own LEFT JOIN decided ON own.host = decided.host AND own.path = decided.path LEFT JOIN shared ON own.place = shared.place"""


def oracle_sql() -> dict[str, str]:
    return {"op5_licence_scan": licence_scan(), "op6_url_filter": judged_urls()}
