"""DuckDB SQL for the parity check: an independent formulation of each query.

The reports here use per-ledger ``row_number()`` first rows and outer joins,
where the Spark side uses one tagged-union aggregation. The fixture's derivation, the
badge template, the entity tables and the steps of entity decoding are shared with
the engine, so mistakes there would not show here; those are held by literal tests. Regex classes are the same Unicode classes as the Spark side
(RE2 with the ``'g'`` flag). Each string is self-contained: the fixture
ledgers are CTEs over the pre-registered base tables.
"""

from __future__ import annotations

from functools import lru_cache

from ledgerspark.functions import entities
from ledgerspark.functions.badges import BADGE_SEPARATOR, BADGE_TEMPLATE
from ledgerspark.sources.fixtures import NAME_MARK, fixture_sql

NON_DIGIT = r"[^\p{Nd}]"
NON_WORD = r"[^\p{L}\p{N}_]"
FMT = "%d/%m/%Y %H:%M"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def text_literal(s: str) -> str:
    """SQL expression for any text, with control characters via ``chr``."""
    if s and all(ch.isprintable() for ch in s):
        return q(s)
    if not s:
        return "''"
    return "(" + " || ".join(q(ch) if ch.isprintable() else f"chr({ord(ch)})" for ch in s) + ")"


def strict(x: str) -> str:
    return f"coalesce(regexp_replace(regexp_replace(cast({x} as varchar), '\\.0$', ''), '{NON_DIGIT}', '', 'g'), '')"


def loose(x: str) -> str:
    return f"coalesce(regexp_replace(cast({x} as varchar), '{NON_DIGIT}', '', 'g'), '')"


def canonical(x: str) -> str:
    return f"upper(regexp_replace({x}, '^\\s+|\\s+$', '', 'g'))"


def badge(name: str, flag: str) -> str:
    green = BADGE_TEMPLATE.format(color="green", name=name)
    red = BADGE_TEMPLATE.format(color="red", name=name)
    return f"case when {flag} then {q(green)} else {q(red)} end"


def badges(*pairs: tuple[str, str]) -> str:
    return f"concat_ws({q(BADGE_SEPARATOR)}, " + ", ".join(badge(n, f) for n, f in pairs) + ")"


def _map_sql(table: dict, int_keys: bool = False) -> str:
    items = sorted(table.items())
    keys = ", ".join(str(k) if int_keys else text_literal(k) for k, _ in items)
    vals = ", ".join(text_literal(v) for _, v in items)
    return f"map([{keys}], [{vals}])"


@lru_cache(maxsize=1)
def _maps() -> tuple[str, str, str]:
    return (_map_sql(entities.named_references()), _map_sql(entities.legacy_references()),
            _map_sql(entities.numeric_remap(), int_keys=True))


def _code_point_sql(n: str, remap: str) -> str:
    return (f"case when {n} in ({', '.join(str(k) for k in sorted(entities.numeric_remap()))}) then {remap}[{n}] "
            f"when ({n} between 55296 and 57343) or {n} > 1114111 then chr(65533) "
            f"when ({n} between 1 and 8) or {n} = 11 or ({n} between 14 and 31) or ({n} between 127 and 159) "
            f"or ({n} between 64976 and 65007) or ({n} & 65534) = 65534 then '' "
            f"else chr(cast({n} as integer)) end")


def _digits_sql(digits: str, base: int) -> str:
    t = f"ltrim({digits}, '0')"
    limit = 7 if base == 10 else 6
    val = f"try_cast({t} as bigint)" if base == 10 else f"try_cast('0x' || {t} as bigint)"
    return f"(case when length({t}) > {limit} then 1114112 when {t} = '' then 0 else {val} end)"


def html_unescape_sql(x: str) -> str:
    named, legacy, remap = _maps()
    dec_re, hex_re, name_re = r"^#([0-9]+);?", r"^#[xX]([0-9a-fA-F]+);?", r"^[^\t\n\f <&#;]{1,32};?"
    dec = f"regexp_extract(p, '{dec_re}', 0)"
    hexa = f"regexp_extract(p, '{hex_re}', 0)"
    name = f"regexp_extract(p, '{name_re}', 0)"
    dec_n = _digits_sql(f"regexp_extract(p, '{dec_re}', 1)", 10)
    hex_n = _digits_sql(f"regexp_extract(p, '{hex_re}', 1)", 16)
    prefix_cases = " ".join(
        f"when length({name}) > {k} and {legacy}[substr({name}, 1, {k})] is not null "
        f"then {legacy}[substr({name}, 1, {k})] || substr({name}, {k + 1}) || substr(p, length({name}) + 1)"
        for k in range(entities.MAX_LEGACY_NAME, 1, -1)
    )
    piece = (
        f"case when {dec} <> '' then ({_code_point_sql(dec_n, remap)}) || substr(p, length({dec}) + 1) "
        f"when {hexa} <> '' then ({_code_point_sql(hex_n, remap)}) || substr(p, length({hexa}) + 1) "
        f"when {name} <> '' and {named}[{name}] is not null then {named}[{name}] || substr(p, length({name}) + 1) "
        f"{prefix_cases} "
        f"else '&' || p end"
    )
    return (f"(case when strpos({x}, '&') = 0 then {x} else array_to_string(list_transform(string_split({x}, '&'), "
            f"lambda p, i: case when i = 1 then p else {piece} end), '') end)")


def with_fixture(body: str) -> str:
    return f"with {fixture_sql()},\n{body}"


# ---------------------------------------------------------------- reports

def _ledgers(cnm, soa, sgp) -> str:
    return f"""
cnm as (select {cnm('documento')} as documento, id, tipo, data_hora, ord from fx_movements),
soa as (select {soa('documento')} as documento, devedor, unique_id, data, fonte, source_rank, ord
        from fx_status_exports),
sgp as (select {sgp('cpf_cnpj')} as documento, nome, ord from fx_registry),
cnm1 as (select * from cnm qualify row_number() over (partition by documento order by ord) = 1),
sgp1 as (select * from sgp qualify row_number() over (partition by documento order by ord) = 1)"""


_LEDGERS = _ledgers(strict, strict, strict)


def q1_ctes(ledgers: str = "") -> str:
    """Q1 as CTEs ending in ``q1`` (reused by the view operators)."""
    return f"""{ledgers or _LEDGERS},
soa1 as (select *, count(unique_id) over (partition by documento) as uid_n from soa
         qualify row_number() over (partition by documento order by source_rank, ord) = 1),
docs as (select documento from cnm union select documento from soa union select documento from sgp),
j as (
  select d.documento, c.documento is not null as p_cnm, s.documento is not null as p_soa,
         g.documento is not null as p_sgp, c.tipo as c_tipo, c.data_hora, s.fonte, s.data as s_data,
         s.devedor, s.unique_id, coalesce(s.uid_n, 0) as uid_n
  from docs d left join cnm1 c using (documento) left join soa1 s using (documento)
       left join sgp1 g using (documento)),
t as (select *, case when p_cnm then c_tipo when p_soa then fonte else '-' end as tipo from j),
q1 as (
select case when uid_n > 0 then unique_id else '-' end as id,
       documento,
       case when p_soa then devedor else '-' end as nome,
       case when p_cnm then strftime(data_hora, '{FMT}') when p_soa then s_data else '-' end as data,
       tipo,
       {badges(('CNM', 'p_cnm'), ('SOA', 'p_soa'), ('SGP', 'p_sgp'))} as local,
       case when {canonical('tipo')} = 'INCLUSAO' then (case when p_sgp then 'NEGATIVADO' else 'ERRO' end)
            when {canonical('tipo')} = 'EXCLUSAO' then (case when p_sgp then 'ERRO' else 'BAIXADO' end)
            else 'ERRO' end as status
from t)"""


def q1_sql() -> str:
    return with_fixture(q1_ctes() + "\nselect * from q1")


def q1_reference_keys_sql() -> str:
    return with_fixture(q1_ctes(_ledgers(loose, strict, loose)) + "\nselect * from q1")


def values_sql(rows: list[dict]) -> str:
    """A literal result."""
    def text(v) -> str:
        return q(v) if isinstance(v, str) else str(v).lower()

    return " union all ".join("select " + ", ".join(f"{text(v)} as {k}" for k, v in r.items()) for r in rows)


def _clean(x: str) -> str:
    return html_unescape_sql(f"coalesce(cast({x} as varchar), 'nan')")


def _clean_uid(x: str) -> str:
    return f"regexp_replace({_clean(x)}, '{NON_WORD}', '', 'g')"


def q2_sql() -> str:
    return with_fixture(f"""{_LEDGERS},
soa1 as (select * from soa where fonte = 'Ativas'
         qualify row_number() over (partition by documento order by source_rank, ord) = 1),
docs as (select documento from cnm union select documento from soa1 union select documento from sgp),
j as (
  select d.documento, c.documento is not null as p_cnm, s.documento is not null as p_soa,
         g.documento is not null as p_sgp, c.id as c_id, c.data_hora, s.unique_id, s.devedor, s.data as s_data
  from docs d left join cnm1 c using (documento) left join soa1 s using (documento)
       left join sgp1 g using (documento))
select case when p_soa then {_clean_uid('unique_id')} when p_cnm then cast(cast(c_id as bigint) as varchar)
            else '-' end as id,
       documento,
       case when p_soa then {_clean('devedor')} else '-' end as nome,
       case when p_soa then {_clean('s_data')} when p_cnm then strftime(data_hora, '{FMT}') else '-' end as data,
       case when p_sgp and (p_cnm or p_soa) then 'INCLUSÃO' when p_cnm and not p_sgp then 'EXCLUSAO'
            else 'ERRO' end as tipo,
       {badges(('CNM', 'p_cnm'), ('SOA', 'p_soa'), ('SGP', 'p_sgp'))} as local,
       case when p_sgp and (p_cnm or p_soa) then 'NEGATIVADO' when p_cnm and not p_sgp then 'BAIXADO'
            else 'ERRO' end as status
from j""")


def q3_sql() -> str:
    return with_fixture(f"""{_LEDGERS},
j as (
  select coalesce(c.documento, g.documento) as documento, c.documento is not null as p_cnm,
         g.documento is not null as p_sgp, c.id as c_id, c.tipo as c_tipo, c.data_hora, g.nome as g_nome
  from cnm1 c full outer join sgp1 g on c.documento = g.documento)
select case when p_cnm then cast(cast(c_id as bigint) as varchar) else '' end as id,
       documento,
       case when p_sgp then g_nome else '' end as nome,
       case when p_cnm then strftime(data_hora, '{FMT}') else '' end as data,
       case when p_cnm then c_tipo else '' end as tipo,
       {badges(('CNM', 'p_cnm'), ('SGP', 'p_sgp'))} as local,
       case when p_cnm and c_tipo = 'INCLUSAO' and p_sgp then 'NEGATIVADO'
            when p_cnm and c_tipo = 'EXCLUSAO' and not p_sgp then 'BAIXADO' else 'ERRO' end as status
from j""")


def q4_sql() -> str:
    return with_fixture(f"""{_LEDGERS},
soa1 as (select * from soa where fonte = 'Ativas'
         qualify row_number() over (partition by documento order by source_rank, ord) = 1),
j as (
  select coalesce(s.documento, g.documento) as documento, s.documento is not null as p_soa,
         g.documento is not null as p_sgp, s.unique_id, s.devedor, s.data as s_data, g.nome as g_nome
  from soa1 s full outer join sgp1 g on s.documento = g.documento)
select case when p_soa then {_clean_uid('unique_id')} else '-' end as id,
       documento,
       case when p_soa then {_clean('devedor')} when p_sgp then g_nome else '-' end as nome,
       case when p_soa then {_clean('s_data')} else '-' end as data_inclusao,
       {badges(('SOA', 'p_soa'), ('SGP', 'p_sgp'))} as local,
       case when p_soa and p_sgp then 'INCLUSÃO' else 'ERRO' end as tipo,
       case when p_soa and p_sgp then 'NEGATIVADO' else 'ERRO' end as status
from j""")


def _movement_status_sql() -> str:
    return f"""
reg as (select distinct {strict('cpf_cnpj')} as documento from fx_registry),
ms as (
  select m.*, {strict('m.documento')} as doc_key,
         exists (select 1 from reg where reg.documento = {strict('m.documento')}) as in_registry
  from fx_movements m),
mss as (
  select *, case when {canonical('tipo')} = 'INCLUSAO' then 'NEGATIVADO'
                 when {canonical('tipo')} = 'EXCLUSAO' then (case when in_registry then 'ERRO' else 'BAIXADO' end)
                 else 'ERRO' end as status
  from ms)"""


def q5_sql() -> str:
    return with_fixture(f"""{_movement_status_sql()}
select status, count(*) as count from mss group by status""")


def movement_status_sql() -> str:
    return with_fixture(f"""{_movement_status_sql()}
select id, documento, tipo, in_registry, status from mss""")


# ---------------------------------------------------------------- operators

def _keys_union_sql(fn) -> str:
    return with_fixture(f"""
k as (select 'CNM' as ledger, ord, documento as raw, {fn('documento')} as documento from fx_movements
      union all select 'SGP', ord, cpf_cnpj, {fn('cpf_cnpj')} from fx_registry
      union all select 'SOA', ord, documento, {fn('documento')} from fx_status_exports)
select * from k""")


def normalize_document_sql() -> str:
    return _keys_union_sql(strict)


def normalize_document_loose_sql() -> str:
    return _keys_union_sql(loose)


def html_unescape_pages_sql() -> str:
    return f"select page_id, {html_unescape_sql('html')} as html from pages"


def strip_non_word_sql() -> str:
    return f"select doc_id, regexp_replace(text, '{NON_WORD}', '', 'g') as text from documents"


def canonical_type_sql() -> str:
    return with_fixture(f"select id, tipo, {canonical('tipo')} as tipo_canonical from fx_movements")


def format_movement_date_sql() -> str:
    return with_fixture(f"""
d as (select 'CNM' as ledger, ord, strftime(data_hora, '{FMT}') as data from fx_movements
      union all select 'SOA', ord, strftime({_parsed('data')}, '{FMT}') from fx_status_exports)
select * from d""")


def _parsed(x: str) -> str:
    """A text date by the first layout that fits: day-first, month-first, ISO."""
    days = ("%d/%m/%Y", "%m/%d/%Y", "%Y-%m-%d")
    layouts = [f"{d}{t}" for d in days for t in (" %H:%M:%S", "T%H:%M:%S", " %H:%M", "")]
    return "coalesce(" + ", ".join(f"try_strptime(trim({x}), '{p}')" for p in layouts) + ")"


def intake_report_sql() -> str:
    def blank(x: str) -> str:
        return f"count(*) filter ({strict(x)} = '')"

    return with_fixture(f"""
r as (select 'CNM' as ledger, count(*) as rows, {blank('documento')} as blank_documents,
             count(*) filter (data_hora is null) as unreadable_dates from fx_movements
      union all select 'SGP', count(*), {blank('cpf_cnpj')}, 0 from fx_registry
      union all select 'SOA', count(*), {blank('documento')}, count(*) filter ({_parsed('data')} is null)
      from fx_status_exports)
select * from r""")


def extract_registry_sql(tag: str) -> str:
    return with_fixture(f"""x as (select 1) select cpf_cnpj, nome from fx_customers where tag = '{tag}'""")


def scan_registry_sql() -> str:
    return with_fixture("x as (select 1) select cpf_cnpj, nome from fx_registry")


def workbook_filters_sql(types: tuple[str, ...], since: str) -> str:
    named = ", ".join(map(q, types))
    return with_fixture(f"x as (select 1) select cast(id as varchar) as id, documento, tipo from fx_movements "
                        f"where tipo in ({named}) and documento >= {q(since)}")


def empty_exports_sql() -> str:
    return with_fixture("x as (select 1) select documento, devedor, unique_id, data, fonte from fx_status_exports where false")


def newest_versions_sql(tag: str) -> str:
    return with_fixture(f"x as (select 1) select cpf_cnpj, nome, tag from fx_customers where tag = '{tag}'")


def overwritten_files_sql(again: tuple[str, ...]) -> str:
    names = ", ".join(f"'{f}'" for f in again)
    return with_fixture(f"""
select cast(0 as integer) as run, fonte || '.csv' as name, 'new' as event,
       cast(length('rows') + 1 + length(cast(count(*) as varchar)) as bigint) as length
from fx_status_exports group by fonte
union all
select cast(1 as integer), fonte || '.csv', 'overwritten',
       cast(length('unique ids') + 1 + length(cast(count(unique_id) as varchar)) as bigint)
from fx_status_exports where fonte in ({names}) group by fonte""")


def stream_changes_sql(tag: str) -> str:
    """Rows of the full report that differ from the report without the registry segment ``tag``."""
    full = q1_ctes()
    part = full.replace("from fx_registry)", f"from fx_registry where tag <> '{tag}')")
    return f"""select * from ({with_fixture(full)} select * from q1)
except select * from ({with_fixture(part)} select * from q1)"""


_FLAGS = f"""{_LEDGERS},
docs as (select documento from cnm union select documento from soa union select documento from sgp),
flags as (
  select documento,
         exists (select 1 from cnm where cnm.documento = docs.documento) as in_cnm,
         exists (select 1 from soa where soa.documento = docs.documento) as in_soa,
         exists (select 1 from sgp where sgp.documento = docs.documento) as in_sgp
  from docs)"""


def presence_flags_sql() -> str:
    return with_fixture(_FLAGS + "\nselect documento, in_cnm, in_soa, in_sgp from flags")


def presence_badges_sql() -> str:
    return with_fixture(_FLAGS + f"""
select documento, {badges(('CNM', 'in_cnm'), ('SOA', 'in_soa'), ('SGP', 'in_sgp'))} as local from flags""")


def concat_sources_sql(files: list[tuple[str, tuple[str, ...]]]) -> str:
    parts = []
    for fonte, missing in files:
        cols = ", ".join("null as " + c if c in missing else c for c in ("devedor", "unique_id"))
        parts.append(f"select documento, {cols}, data, '{fonte}' as fonte, ord from fx_status_exports "
                     f"where fonte = '{fonte}'")
    return with_fixture("u as (" + "\n union all ".join(parts) + ")\nselect * from u")


def document_universe_sql() -> str:
    return with_fixture(f"""{_LEDGERS}
select documento from cnm union select documento from soa union select documento from sgp""")


def in_registry_sql() -> str:
    return with_fixture(f"""{_LEDGERS}
select ord, documento, exists (select 1 from sgp where sgp.documento = soa.documento) as in_registry from soa""")


def only_in_cnm_sql() -> str:
    return with_fixture(f"""{_LEDGERS}
select distinct documento from cnm where not exists (select 1 from sgp where sgp.documento = cnm.documento)""")


def in_both_sql() -> str:
    return with_fixture(f"""{_LEDGERS}
select distinct documento from cnm where exists (select 1 from sgp where sgp.documento = cnm.documento)""")


def first_row_per_document_sql() -> str:
    return with_fixture(f"""{_LEDGERS}
select documento, devedor, unique_id, data, fonte from soa
qualify row_number() over (partition by documento order by source_rank, ord) = 1""")


def sources_per_document_sql() -> str:
    return with_fixture(f"""{_LEDGERS},
s as (select documento, string_agg(fonte, ',' order by source_rank) as f
      from (select distinct documento, fonte, source_rank from soa) x group by documento),
c as (select documento, case when tipo = 'INCLUSAO' then 'CNM' else 'CNM_EXCLUSAO' end as tag from cnm1),
docs as (select documento from cnm union select documento from soa)
select d.documento, concat_ws(',', s.f, c.tag) as fontes
from docs d left join s using (documento) left join c using (documento)""")


def all_null_per_document_sql() -> str:
    return with_fixture(f"""{_LEDGERS}
select documento, count(unique_id) = 0 as all_null from soa group by documento""")


def _visible(x: str) -> str:
    return f"coalesce(regexp_replace(cast({x} as varchar), '<[^>]*>', '', 'g'), '')"


def search_rows_sql(text: str) -> str:
    row = "lower(concat_ws(' ', " + ", ".join(_visible(c) for c in
                                               ("id", "documento", "nome", "data", "tipo", "local", "status")) + "))"
    conds = " and ".join(f"strpos({row}, {q(t.lower())}) > 0" for t in text.split())
    return with_fixture(q1_ctes() + f"\nselect * from q1 where {conds}")


def _order_sql(by: list[tuple[str, bool]]) -> str:
    parts = [f"{c} desc nulls last" if desc else f"{c} asc nulls first" for c, desc in by]
    if "documento" not in [c for c, _ in by]:
        parts.append("documento asc nulls first")
    return ", ".join(parts)


def sort_rows_sql(by) -> str:
    return with_fixture(q1_ctes() + f"\nselect *, row_number() over (order by {_order_sql(by)}) - 1 as pos from q1")


def page_rows_sql(page: int, by, size: int) -> str:
    return with_fixture(q1_ctes() + f"\nselect * from q1 order by {_order_sql(by)} limit {size} offset {size * (page - 1)}")


def facet_values_sql(columns) -> str:
    parts = [f"select distinct '{c}' as facet, cast({c} as varchar) as value from q1 where {c} is not null and {c} <> ''"
             for c in columns]
    return with_fixture(q1_ctes() + "\n" + " union all ".join(parts))


def facet_filter_sql(choices: dict) -> str:
    conds = " and ".join(f"lower({_visible(c)}) = {q(v.lower())}" for c, v in choices.items() if v)
    return with_fixture(q1_ctes() + f"\nselect * from q1 where {conds}")


def facet_counts_sql(columns, choices: dict) -> str:
    parts = []
    for c in columns:
        conds = "".join(f" and lower({_visible(o)}) = {q(v.lower())}" for o, v in choices.items() if v and o != c)
        parts.append(f"select '{c}' as facet, cast({c} as varchar) as value, count(*) as n from q1 "
                     f"where {c} is not null and {c} <> ''{conds} group by {c}")
    return with_fixture(q1_ctes() + "\n" + " union all ".join(parts))


def view_subtitle_sql(choices: dict, by, captions: dict) -> str:
    conds = " and ".join(f"lower({_visible(c)}) = {q(v.lower())}" for c, v in choices.items() if v) or "true"
    cap = " ".join(f"when {q(k)} then {q(v)}" for k, v in captions.items())
    return with_fixture(q1_ctes() + f""",
first as (select status from q1 where {conds} order by {_order_sql(by)} limit 1),
one as (select 1 as x)
select first.status, coalesce(case first.status {cap} end, '') as subtitulo from one left join first on true""")


def html_rows_sql(columns) -> str:
    cells = " || ".join(f"'<td>' || coalesce(cast({c} as varchar), 'NaN') || '</td>'" for c in columns)
    return with_fixture(q1_ctes() + f"\nselect documento, '<tr>' || {cells} || '</tr>' as html from q1")


def extract_predicates_sql(since: str) -> str:
    return with_fixture(f"""
select id, documento, tipo from fx_movements where data_hora >= timestamp '{since}'""")


def scan_multiline_exports_sql() -> str:
    return f"""select * replace (replace(devedor, '{NAME_MARK}', chr(10)) as devedor)
from ({scan_status_exports_sql()})"""


def scan_status_exports_sql() -> str:
    return with_fixture("select documento, devedor, unique_id, data, fonte, source_rank from fx_status_exports")


def scan_movements_sql() -> str:
    return with_fixture(f"select cast(id as varchar) as id, documento, tipo, strftime(data_hora, '{FMT}') as data "
                        "from fx_movements")
