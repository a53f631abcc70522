"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

from .license_scan import BLANK_LINES, COPYRIGHT_LINE, NOT_WORD, SPELLINGS, known_texts
from .queries import WEIGHTS
from .url_reputation import RULES, TWO_LABEL_SUFFIXES, Reputation


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _spelled(sql: str) -> str:
    padded = f"' ' || {sql} || ' '"
    for spelling, form in SPELLINGS.items():
        padded = f"replace({padded}, ' {spelling} ', ' {form} ')"
    return f"trim({padded})"


def _plain(sql: str) -> str:
    return f"""list_filter(list_transform(list_filter(string_split(coalesce({sql}, ''), chr(10)),
        lambda x: not regexp_matches(x, {_text(COPYRIGHT_LINE)})), lambda x: trim(regexp_replace(lower(x), {_text(NOT_WORD)}, ' ', 'g'))),
        lambda x: x <> '')"""


def license_digests() -> str:
    known = ", ".join(f"({_text(name)}, {_text(text)})" for name, texts in known_texts().items() for text in texts)
    joined = _spelled("array_to_string(r, ' ')")
    return f"""
    with known as (
        select sha256({_spelled(f"array_to_string({_plain('text')}, ' ')")}) as d, min(name) as name
        from (values {known}) k(name, text) group by d),
    cut as (
        select row_number() over () as r, doc_id,
            list_transform(string_split_regex(coalesce(text, ''), {_text(BLANK_LINES)}), lambda r: {_plain('r')}) as runs from documents),
    scanned as (select r, doc_id, runs, flatten(runs) as lines from cut),
    units as (
        select r, unnest(list_transform(lines, lambda x: sha256({_spelled('x')}))) as d from scanned
        union all
        select r, unnest(list_transform(list_filter(runs, lambda r: len(r) > 1 and len(r) < len(lines)), lambda r: sha256({joined}))) from scanned),
    hits as (select r, string_agg(distinct name, ',' order by name) as notices from units join known using (d) group by r),
    whole as (select r, doc_id, sha256({_spelled("array_to_string(lines, ' ')")}) as digest from scanned)
    select doc_id, digest, name as license, coalesce(notices, '') as notices
    from whole left join known on digest = d left join hits using (r)"""


def poisson_mix() -> str:
    weights = ", ".join(f"({_text(s)}, {w!r}::double)" for s, w in WEIGHTS.items())
    norm = "(select sum(w) from weights where s in (select source from documents))"
    return f"""
    with recursive weights(s, w) as (values {weights}),
    sizes as (select case when source in (select s from weights) then source end as s, count(*) as n from documents group by 1),
    whole as (select sum(n)::hugeint as total, coalesce(sum(n) filter (s is null), 0)::hugeint as others from sizes),
    rates as (
        select s, w / {norm} * case when others > 0 then (total * (total - others))::double / total else total end / n as rate
        from weights join sizes using (s), whole
        union all
        select null, 1.0::double from whole where others > 0),
    steps(s, rate, k, term, total) as (
        select s, rate, 0, exp(-rate), exp(-rate) from rates
        union all
        select s, rate, k + 1, term * (rate / (k + 1)), total + term * (rate / (k + 1)) from steps where k < 3 * rate + 60),
    cdf as (select s, list(total order by k) as totals from steps group by s),
    drawn as (
        select d.*, len(list_filter(totals, lambda x: x <=
            ('0x' || substr(md5('mix-1|' || coalesce(doc_id::varchar, 'null')), 1, 13))::bigint / 4503599627370496.0)) as n
        from documents d join cdf on s is not distinct from case when source in (select s from weights) then source end)
    select doc_id, text, lang, source, n_chars, copy::int as copy,
        md5('mix-1|' || coalesce(doc_id::varchar, 'null') || '|' || copy::varchar) as mix_key
    from (select * exclude (n), unnest(range(n)) as copy from drawn)"""


def url_reputation() -> str:
    fits = "\n".join(
        f"when (host = {_text(r.split('/')[0])} or host like {_text('%.' + r.split('/')[0])}) and starts_with(path, {_text(r[r.index('/'):])}) then {_text(r)}"
        for r in sorted(RULES, key=len, reverse=True)
    )
    verdicts = "\n".join(f"when rule = {_text(r)} then {_text(v)}" for r, v in RULES.items())
    two = ", ".join(map(_text, TWO_LABEL_SUFFIXES))
    limits = Reputation()
    bound = f"greatest({limits.least_correlation!r}, least({limits.most_correlation!r}, coalesce("
    same = (
        f"(select {bound} sum((bad - n * prior) * (bad - n * prior) - n * prior * (1 - prior))"
        " / nullif(sum(n * (n - 1) * prior * (1 - prior)), 0), 0))) from {0})"
    )
    return f"""
    with parsed as (
        select page_id,
            translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
            regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) as path
        from pages),
    marks as (select doc_id, max(case when quality = 0 or toxic = 1 then 1 when quality is null and toxic is null then null else 0 end) as bad
        from labels where doc_id is not null group by doc_id),
    counts as (select host, count(bad) as n, coalesce(sum(bad), 0)::bigint as bad
        from parsed left join marks on page_id = doc_id group by host),
    parts as (select *, string_split(regexp_replace(host, '\\.?(:[0-9]*)?$', ''), '.') as p from counts),
    named as (select *, array_to_string(p[-2:], '.') as last_two, array_to_string(p[-3:], '.') as last_three, p[-1] as last_one from parts),
    hosts as (select host, n, bad, case when last_two in ({two}) then last_two else last_one end as suffix,
        case when last_two in ({two}) then last_three else last_two end as domain from named),
    a as (select suffix, sum(n) as n, sum(bad) as bad, (select sum(bad) / nullif(sum(n), 0) from hosts) as prior from hosts group by suffix),
    ka as (select 1 / {same.format('a')} - 1 as k),
    b as (select h.suffix, h.domain, h.n, h.bad, (a.bad + k * a.prior) / (a.n + k) as prior
        from (select suffix, domain, sum(n) as n, sum(bad) as bad from hosts group by all) h join a using (suffix), ka),
    kb as (select 1 / {same.format('b')} - 1 as k),
    c as (select h.host, h.n, h.bad, (b.bad + k * b.prior) / (b.n + k) as prior
        from hosts h join b using (suffix, domain), kb),
    kc as (select 1 / {same.format('c')} - 1 as k),
    rated as (select host, (bad + k * prior) / (n + k) as rate, n + k as size from c, kc),
    judged as (select host, rate - {limits.z!r} * sqrt(rate * (1 - rate) / (size + 1)) > {limits.max_bad_rate!r} as blocked from rated),
    ruled as (select *, case {fits} end as rule from parsed)
    select page_id, host, path, rule, case {verdicts} when blocked then 'block' else 'allow' end as verdict
    from ruled join judged using (host)"""


def dual_tree_top_k() -> str:
    return """
    with whole as (
        select row_number() over () as uid, vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::hugeint) as v
        from embeddings
        where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    scored as (
        select q.uid, q.vec_id as query_id, d.vec_id,
            coalesce(list_sum(list_transform(list_zip(q.v, d.v), lambda p: p[1] * p[2])), 0)::bigint as score
        from whole q join whole d on q.uid <> d.uid and len(q.v) = len(d.v)
        where q.vec_id % 50 = 0)
    select query_id, rank::int as rank, vec_id, score
    from (select *, row_number() over (partition by uid order by score desc, vec_id nulls last) as rank from scored)
    where rank <= 5"""


def cover_negatives() -> str:
    return """
    with whole as (
        select row_number() over () as uid, vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::hugeint) as v,
            case when vec_id % 7 = 0 then (label::bigint + 1) % 10 else label end as label
        from embeddings
        where embedding is not null and label is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    scored as (
        select a.uid as a, a.vec_id as anchor_id, d.uid, d.vec_id, a.label = d.label as same,
            coalesce(list_sum(list_transform(list_zip(a.v, d.v), lambda p: p[1] * p[2])), 0)::bigint as score
        from whole a join whole d on a.uid <> d.uid and len(a.v) = len(d.v)
        where a.vec_id % 100 = 0),
    positives as (
        select a, anchor_id, uid as p, vec_id as positive_id, score as positive_score from scored where same
        qualify row_number() over (partition by a order by score desc, vec_id nulls last, uid) <= 5)
    select p.anchor_id, positive_id, (row_number() over (partition by p.a, p order by score desc, vec_id nulls last, uid))::int as rank,
        vec_id as negative_id, positive_score, score as negative_score
    from positives p join scored s on p.a = s.a and not same
        and 30 * positive_score::hugeint <= 100 * score::hugeint and 100 * score::hugeint <= 90 * positive_score::hugeint
    qualify rank <= 10"""


def crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text, bit by bit."""
    bit = "lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end"
    byte = f"lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), {bit})"
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::bigint)"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {codes}), {byte}), 4294967295)"


def merkle_manifest(heights: int = 6, above: int = 4) -> str:
    """For up to 16 ** heights rows per source and 16 ** above sources."""
    fields = ["doc_id::varchar", "source", "lang", "n_chars::varchar", "{}"]
    leaf = "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [f"""
    with rows as (
        select doc_id, source, {leaf.format("text", "text")} as leaf,
            case when {crc32("doc_id::varchar")} % 5 = 0 then {leaf.format(lowered, lowered)} end as other
        from documents),
    n0 as (
        select source as g, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as p, leaf as h,
            count(*) over (partition by source) as n, doc_id, other
        from rows),
    d0 as (select doc_id, g, p, h as leaf, coalesce(other, h) as cur, '' as proof from n0)"""]
    for k in range(heights + above):
        if k == heights:
            parts.append(f""",
    subroots as (select g, h, row_number() over (order by g nulls first) - 1 as p from n{k}),
    t{k} as (select 0 as g, p, h, count(*) over () as n from subroots),
    e{k} as (select doc_id, leaf, cur, proof, s.h as subroot, 0 as g, s.p from d{k} d join subroots s on d.g is not distinct from s.g)""")
        nodes, docs = ("n", "d") if k < heights else ("t", "e")
        kept = "doc_id, leaf" if k < heights else "doc_id, leaf, subroot"
        parts.append(f""",
    r{k} as (select g, p // 16 as p, list(h order by p) as run, any_value(n) as n from {nodes}{k} group by g, p // 16),
    {nodes}{k + 1} as (select g, p, case when n = 1 then run[1] else sha256(array_to_string(run, '')) end as h, (n + 15) // 16 as n from r{k}),
    {docs}{k + 1} as (
        select {kept}, d.g, d.p // 16 as p,
            case when n = 1 then cur else sha256(array_to_string(run[:d.p % 16], '') || cur || array_to_string(run[d.p % 16 + 2:], '')) end as cur,
            case when n = 1 then proof else proof || array_to_string(run[:d.p % 16], '') || array_to_string(run[d.p % 16 + 2:], '') end as proof
        from {docs}{k} d join r{k} r on d.g is not distinct from r.g and d.p // 16 = r.p)""")
    last = heights + above
    return "".join(parts) + f"""
    select doc_id, leaf, subroot, (select h from t{last}) as root, sha256(proof) as proof_sha256, cur as folded_root,
        cur = (select h from t{last}) as verified
    from e{last}"""


ORACLES: dict[str, str] = {
    "op2_url_reputation": url_reputation(),
    "op5_license_digests": license_digests(),
    "op6_dual_tree_top_k": dual_tree_top_k(),
    "op10_poisson_mix": poisson_mix(),
    "op11_cover_negatives": cover_negatives(),
    "op12_merkle_manifest": merkle_manifest(),
}
