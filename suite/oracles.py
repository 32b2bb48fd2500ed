"""DuckDB texts that give the same rows as the registered queries.

They state each operator in its literal form: row numbers, windows, full
products and chained joins.
"""

from __future__ import annotations

LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate"
LINE5 = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"
PREFIX = "case p_size % 3 when 0 then 'CA' when 1 then 'CAB' else 'CAC' end"
KINDS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]

FIT = f"""
with fit as (
  select row_number() over (order by {LINE}) as seq, {LINE},
    n_name as "Name", c_name as "VM", o_orderpriority as "TypeName", o_orderstatus as "Engines",
    cast(p_size as varchar) as "HorsePowers",
    case l_linenumber % 4
      when 0 then strftime(o_orderdate, '%Y%m') || '-'
      when 1 then '-' || strftime(l_shipdate, '%Y%m')
      when 2 then strftime(o_orderdate, '%Y%m')
      else strftime(o_orderdate, '%Y%m') || '-' || strftime(l_shipdate, '%Y%m') end as "Year",
    p_type as "GenericArticle",
    {PREFIX} || cast(p_partkey as varchar) as "ArticleNumber"
  from lineitem
  join part on l_partkey = p_partkey
  join orders on l_orderkey = o_orderkey
  join customer on o_custkey = c_custkey
  join nation on c_nationkey = n_nationkey)
"""

K_STEPS = """
, k as (select * from fit qualify row_number() over (
    partition by Name, VM, ArticleNumber, Engines, TypeName order by seq) = 1)
, names as (select * from k qualify row_number() over (
    partition by Name, VM, Engines, TypeName order by seq) = 1)
"""
K = FIT + K_STEPS


def _pivot(fit: str, kinds: list[str]) -> str:
    return fit + K_STEPS + f"""
, k2 as (select * from k qualify row_number() over (
    partition by Name, VM, Engines, Year, HorsePowers, ArticleNumber order by seq) = 1)
, k3 as (select *, cast((row_number() over (
    partition by Name, VM, Engines, GenericArticle order by seq) - 1) // 100000 as int) as page from k2)
, pv as (select Name, VM, Engines, page, {", ".join(
    f"coalesce(string_agg(ArticleNumber, ',' order by seq) filter (where GenericArticle = '{c}'), '') as {c}"
    for c in kinds)}
  from k3 group by Name, VM, Engines, page)
"""


PIVOT = _pivot(FIT, KINDS)

ENVELOPE = """
  select Name, VM,
    min(case when rn = 1 then case when s <> '' then s else Year end when s <> '' then s end) as start_date,
    max(case when rn = 1 then case when e <> '' then e else Year end when e <> '' then e end) as end_date
  from (select *, row_number() over (partition by Name, VM order by ord_) as rn,
          split_part(Year, '-', 1) as s,
          case when Year like '%-%' then split_part(Year, '-', 2) else Year end as e
        from {source}) t
  group by Name, VM
"""


def _report(fit: str, kinds: list[str]) -> str:
    return _pivot(fit, kinds) + f"""
, v as (select *, row_number() over (order by Name, VM, seq) as ord_ from names)
, env as ({ENVELOPE.format(source="v")})
, models as (select Name, VM, min(ord_) as m_at from v group by Name, VM)
, brands as (select Name, min(ord_) as b_at from v group by Name)
, eng as (select Name, VM, TypeName, Engines, arg_min(HorsePowers, ord_) as hp, min(ord_) as ord_
          from v group by Name, VM, TypeName, Engines)
, types as (select Name, VM, TypeName, min(ord_) as t_at, arg_min(Engines, ord_) as first_engine,
            string_agg(Engines, ', ' order by ord_) as codes, string_agg(hp, ', ' order by ord_) as hps
          from eng group by Name, VM, TypeName)
, shown as (select *, lag(VM) over (order by b_at, m_at) is not distinct from VM as hidden
            from models join brands using (Name) join env using (Name, VM))
, rows_ as (
  select 1 as level, Name as label, '' as codes, '' as hps, b_at, -1 as m_at, -1 as t_at,
    null as n, null as m, null as e from brands
  union all
  select 2, VM || ' ' || right(start_date, 2) || '.' || left(start_date, length(start_date) - 2)
      || '-' || right(end_date, 2) || '.' || left(end_date, length(end_date) - 2),
    '', '', b_at, m_at, -1, null, null, null from shown where not hidden
  union all
  select 3, TypeName, codes, hps, b_at, m_at, t_at, Name, VM, first_engine
  from types join models using (Name, VM) join brands using (Name))
, rep as (select row_number() over (order by b_at, m_at, t_at, coalesce(pv.page, 0)) - 1 as row_no,
    label as "МОДЕЛЬ", codes as "КОД ДВИГАТЕЛЯ", hps as "Мощность Л.С",
    {", ".join(f"pv.{c}" for c in kinds)}, cast(level as int) as level,
    coalesce(pv.page, 0) as page
  from rows_ left join pv on n = Name and m = VM and e = Engines)
"""


REPORT = _report(FIT, KINDS)


def _picked(cell: str, condition: str) -> str:
    """Members of a text list that meet a condition on ``x``, trimmed, re-joined."""
    return (
        f"array_to_string(list_filter(list_transform(string_split(coalesce({cell}, ''), ','), "
        f"lambda y: trim(y)), lambda x: {condition}), ', ')"
    )


def _buckets(cell: str, names: dict[str, str] | None = None) -> str:
    return ", ".join(
        f"{_picked(cell, condition)} as {(names or {}).get(name, name)}"
        for name, condition in [
            ("CAC", "starts_with(x, 'CAC')"),
            ("CAB", "starts_with(x, 'CAB')"),
            ("CA", "starts_with(x, 'CA') and not starts_with(x, 'CAC') and not starts_with(x, 'CAB')"),
        ]
    )


def _brand_documents() -> str:
    """Types, then models, then brands as JSON text, each in first-seen order."""
    return f"""
, eng as (select * from fit qualify row_number() over (partition by Name, VM, TypeName, Engines order by seq) = 1)
, typ as (select Name, VM, TypeName, min(seq) as seen,
    '"' || TypeName || '":{{' || string_agg('"' || Engines || '":"' || HorsePowers || '"', ',' order by seq) || '}}' as txt
  from eng group by Name, VM, TypeName)
, mod as (select Name, VM, min(seen) as seen, '"' || VM || '":{{"start_date":"' || any_value(start_date) || '","end_date":"'
    || any_value(end_date) || '",' || string_agg(txt, ',' order by seen) || '}}' as txt
  from typ join ({ENVELOPE.format(source="(select *, seq as ord_ from fit)")}) env using (Name, VM) group by Name, VM)
, whole as (select Name, '{{"' || Name || '":{{' || string_agg(txt, ',' order by seen) || '}}}}' as json from mod group by Name)
"""


SPLIT = REPORT + f"""
, split as (select row_no, page, level, "МОДЕЛЬ", "КОД ДВИГАТЕЛЯ", "Мощность Л.С",
    {", ".join(KINDS[:-1])}, {_buckets("STANDARD")} from rep)
"""

REPORT_KEYS = ['"МОДЕЛЬ"', '"КОД ДВИГАТЕЛЯ"', '"Мощность Л.С"']


def _product(source: str, row: str, keys: list[str], lists: list[str], plain: list[str]) -> str:
    """CTEs ``p0`` ... ``pn``: one unnest per list, with the positions as ``i<n>``."""
    text = ""
    done: list[str] = []
    last = source
    for n, c in enumerate(lists):
        rest = [x for x in [*keys, *lists, *plain] if x != c]
        pos = "".join(f", {i}" for i in done)
        text += f"""
, p{n} as (select {row}{pos}, {", ".join(rest)}, unnest(l) as {c}, unnest(range(1, len(l) + 1)) as i{n}
    from (select *, coalesce(string_split({c}, ','), [null]) as l from {last}))"""
        done.append(f"i{n}")
        last = f"p{n}"
    return text


def _masked(name: str, source: str, order: str, keys: list[str], cells: list[str]) -> str:
    by = ", ".join(keys)
    shown = ", ".join(
        f"case when row_number() over (partition by {by}, {c} order by {order}) = 1 then {c} end as {c}"
        for c in cells
    )
    return f"\n, {name} as (select {order}, {by}, {shown} from {source})"


SPREAD_LISTS = ["LARGE", "MEDIUM", "PROMO", "CAC", "CAB", "CA"]
SPREAD_CELLS = ["ECONOMY", "SMALL", *SPREAD_LISTS]
_ORDER6 = "row_no, " + ", ".join(f"i{n}" for n in range(6))
_COLUMNS = ", ".join([*REPORT_KEYS, *SPREAD_CELLS])
_LIST_COLUMNS = ", ".join([*REPORT_KEYS, *SPREAD_LISTS])

SPREAD = SPLIT + f"""
, hop as (select row_no, {", ".join(f"nullif({c}, '') as {c}" for c in [*REPORT_KEYS, *SPREAD_CELLS])}
    from split)
""" + _product("hop", "row_no", REPORT_KEYS, SPREAD_LISTS, ["ECONOMY", "SMALL"]) + _masked(
    "m", "p5", _ORDER6, REPORT_KEYS, SPREAD_CELLS
) + f"""
, spread as (select * from m qualify count(*) over (partition by {_COLUMNS}) = 1)
"""

CRITERIA = f"""
  select {PREFIX} || cast(p_partkey as varchar) as "ArticleNumber", o_orderpriority as "VM_df2",
    'Brand: ' || l_returnflag || ' ' || l_linestatus || ' ' || p_brand as "NEW_CRIT", {LINE}
  from lineitem join part on l_partkey = p_partkey join orders on l_orderkey = o_orderkey
"""


def _notes(source: str) -> str:
    return f"""
, notes as (select * from ({source}) qualify
    count(*) over (partition by "ArticleNumber", "NEW_CRIT", "VM_df2") = 1)
, lookup as (select *, row_number() over (order by {LINE}) as pos from notes)
"""


def _attached(source: str, order: str, keys: list[str], cells: list[str]) -> str:
    """Chained left joins, the show-once mask, then distinct rows."""
    text = ""
    last = source
    for n, c in enumerate(cells):
        rest = [x for x in [*keys, *cells] if x != c]
        columns = ", ".join(f"a.{x} as {x}" for x in rest)
        text += f"""
, j{n} as (select {order}, {columns}, a.{c} || ' ' || coalesce("NEW_CRIT", '') as {c}, pos as q{n}
    from {last} a left join lookup l
      on a.{c} is not distinct from l."ArticleNumber" and a.{keys[0]} is not distinct from l."VM_df2")"""
        order += f", q{n}"
        last = f"j{n}"
    text += _masked("once", last, order, keys, cells)
    return text + f"\nselect distinct {', '.join([*keys, *cells])} from once"


def _tail_stages(source: str, row: str, lists: list[str], columns: list[str]) -> str:
    """CTEs ``t0`` ... ``tn``: before each unnest the table moves down by two rows."""
    text, last, pos = "", source, [row]
    for n, c in enumerate(lists):
        rest = [x for x in columns if x != c]
        text += f"""
, s{n} as (select {", ".join(pos)}, {", ".join(rest)}, {c} from (
      select *, row_number() over (order by {", ".join(f"{p} desc" for p in pos)}) as back from {last})
    where back > 2
  union all select {", ".join("-1" for _ in pos)}, {", ".join("null" for _ in [*rest, c])} from range(2))
, t{n} as (select {", ".join(pos)}, {", ".join(rest)}, unnest(l) as {c},
      unnest(range(1, len(l) + 1)) as i{n}
    from (select *, coalesce(string_split({c}, ','), [null]) as l from s{n}))"""
        last = f"t{n}"
        pos = [*pos, f"i{n}"]
    return text


_TAIL_STAGES = _tail_stages(
    "src", "rid", ["A", "N", "R"], ["o_custkey", "o_orderpriority", "o_orderstatus", "month", "A", "N", "R"]
)

_HOP = f"""
, hop as (select row_no, {", ".join(f"nullif({c}, '') as {c}" for c in [*REPORT_KEYS, *SPREAD_CELLS])}
    from split)
"""

# Fifteen categories, eight of which are spread.
WIDE_KINDS = [f"K{i}" for i in range(15)]
WIDE_LISTS = WIDE_KINDS[:8]
_ORDER8 = "row_no, " + ", ".join(f"i{n}" for n in range(8))
_WIDE_COLUMNS = ", ".join([*REPORT_KEYS, *WIDE_KINDS])
WIDE = (
    _report(FIT.replace('p_type as "GenericArticle"', """'K' || (p_partkey % 15) as "GenericArticle\""""), WIDE_KINDS)
    + f"""
, hop as (select row_no, {", ".join(f"nullif({c}, '') as {c}" for c in [*REPORT_KEYS, *WIDE_KINDS])}
    from rep)
"""
    + _product("hop", "row_no", REPORT_KEYS, WIDE_LISTS, WIDE_KINDS[8:])
    + _masked("m", "p7", _ORDER8, REPORT_KEYS, WIDE_KINDS)
    + f"\nselect {_WIDE_COLUMNS} from m qualify count(*) over (partition by {_WIDE_COLUMNS}) = 1"
)

LISTS = f"""
with cells as (select l_orderkey, {", ".join(
    f"string_agg(cast(cast(trunc(l_quantity) as int) as varchar), ',' order by {LINE}) "
    f"filter (where l_returnflag = '{c}') as {c}" for c in "ANR")}
  from lineitem group by l_orderkey)
, src as (select o_orderkey as rid, o_custkey, o_orderpriority, o_orderstatus,
    strftime(o_orderdate, '%Y%m') as month, A, N, R
  from orders left join cells on o_orderkey = l_orderkey)
"""
_SPREAD_KEYS = ["o_custkey", "o_orderpriority", "o_orderstatus"]
_SPREAD_OUT = "o_custkey, o_orderpriority, o_orderstatus, A, N, R, month"
_BLANK = r"[\t\n\x0b\f\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

ORACLES: dict[str, str] = {
    "keep_first": K + """
select Name, VM, TypeName, Engines, HorsePowers, Year, GenericArticle, ArticleNumber from k""",
    "keep_none": FIT + """
select Name, TypeName, nullif(Engines, 'F') as "Engines", Year, ArticleNumber from fit
group by all having count(*) = 1""",
    "keep_none_rows": """
select event_id, user_id, event_type, props from events
qualify count(*) over (partition by user_id, event_type, props) = 1""",
    "mark_repeats": """
select o_orderkey, o_custkey, o_orderstatus,
  row_number() over (partition by o_custkey, o_orderstatus order by o_orderkey) > 1 as repeated
from orders""",
    "show_once": f"""
with c as (select {LINE}, l_linestatus, l_returnflag, cast(l_partkey as varchar) as part_cell,
    cast(l_suppkey as varchar) as supplier_cell, nullif(l_returnflag, 'N') as flag_cell from lineitem)
select {LINE5}, l_linestatus, l_returnflag, {", ".join(
    f"case when row_number() over (partition by l_linestatus, l_returnflag, {c} order by {LINE}) = 1 "
    f"then {c} end as {c}" for c in ["part_cell", "supplier_cell", "flag_cell"])}
from c""",
    "category_pivot": PIVOT + f"""
select Name, VM, Engines, TypeName, HorsePowers, Year, page, {", ".join(KINDS)}
from names join pv using (Name, VM, Engines)""",
    "period_envelope": FIT + ENVELOPE.format(source="(select *, seq as ord_ from fit)"),
    "period_text": FIT + f"""
select {LINE5}, split_part(Year, '-', 1) as start_text, e as end_text,
  VM || ' ' || right(Year, 2) || '.' || left(Year, length(Year) - 2) || '-'
    || right(e, 2) || '.' || left(e, greatest(length(e) - 2, 0)) as model_label
from (select *, case when Year like '%-%' then split_part(Year, '-', 2) else Year end as e from fit)""",
    "report_levels": FIT + f"""
select Name, VM, TypeName, cast(level as int) as level, {LINE5} from (
  select Name, VM, TypeName, min(seq) as seq,
    3 - (grouping(Name) + grouping(VM) + grouping(TypeName)) as level
  from fit group by grouping sets ((Name), (Name, VM), (Name, VM, TypeName))) g
join (select seq, {LINE5} from fit) f using (seq)""",
    "engine_lists": FIT + """
select Name, VM, TypeName, 0 as page, string_agg(Engines, ', ' order by seq) as "Engines",
  string_agg(HorsePowers, ', ' order by seq) as "HorsePowers"
from (select * from fit qualify row_number() over (
  partition by Name, VM, TypeName, Engines order by seq) = 1)
group by Name, VM, TypeName""",
    "nested_document": FIT + f"""
select Name, VM, null as "TypeName", 0 as page,
  '{{"' || Name || '":{{"' || VM || '":{{"start_date":"' || start_date || '","end_date":"' || end_date || '"}}}}}}' as json
from ({ENVELOPE.format(source="(select *, seq as ord_ from fit)")})
union all
select Name, VM, TypeName, 0 as page,
  '{{"' || Name || '":{{"' || VM || '":{{"' || TypeName || '":{{'
  || string_agg('"' || Engines || '":"' || HorsePowers || '"', ',' order by seq) || '}}}}}}}}' as json
from (select * from fit qualify row_number() over (
  partition by Name, VM, TypeName, Engines order by seq) = 1)
group by Name, VM, TypeName""",
    "document_lines": FIT + f"""
select
  '{{"' || Name || '":{{"' || VM || '":{{"start_date":"' || start_date || '","end_date":"' || end_date || '"}}}}}}' as json
from ({ENVELOPE.format(source="(select *, seq as ord_ from fit)")})
union all
select
  '{{"' || Name || '":{{"' || VM || '":{{"' || TypeName || '":{{'
  || string_agg('"' || Engines || '":"' || HorsePowers || '"', ',' order by seq) || '}}}}}}}}' as json
from (select * from fit qualify row_number() over (
  partition by Name, VM, TypeName, Engines order by seq) = 1)
group by Name, VM, TypeName""",
    "brand_documents": FIT + _brand_documents() + "select Name, 0 as list_page, 0 as type_page, 0 as page, json from whole",
    "brand_lines": FIT + _brand_documents() + "select json from whole",
    "cabin_report": REPORT + f"""
select row_no, page, level, "МОДЕЛЬ", "КОД ДВИГАТЕЛЯ", "Мощность Л.С", {", ".join(KINDS[:-1])},
  {_buckets("STANDARD", {"CAC": '"Салонный фильтр CAC"', "CAB": '"Салонный фильтр CAB"', "CA": '"Салонный фильтр CA"'})}
from rep""",
    "vehicle_report": REPORT + "select * from rep",
    "report_split": SPLIT + "select * from split",
    "sorted_pivot": PIVOT + f"""
select row_number() over (order by Name, VM, seq, page) - 1 as rank,
  Name, VM, Engines, TypeName, HorsePowers, Year, page, {", ".join(KINDS)}
from names join pv using (Name, VM, Engines)""",
    "report_spread": SPREAD + f"select {_COLUMNS} from spread",
    # Pages change the way, not the rows.
    "report_spread_paged": SPLIT + _HOP + _product("hop", "row_no", REPORT_KEYS, SPREAD_LISTS, [])
    + _masked("m", "p5", _ORDER6, REPORT_KEYS, SPREAD_LISTS)
    + f"\nselect {_LIST_COLUMNS} from m qualify count(*) over (partition by {_LIST_COLUMNS}) = 1",
    "report_spread_tail": SPLIT + _HOP
    + _tail_stages("hop", "row_no", SPREAD_LISTS, [*REPORT_KEYS, *SPREAD_CELLS])
    + _masked("m", "t5", _ORDER6, REPORT_KEYS, SPREAD_CELLS)
    + f"\nselect {_COLUMNS} from m qualify count(*) over (partition by {_COLUMNS}) = 1",
    "report_spread_wide": WIDE,
    "report_criteria": SPREAD + _notes(CRITERIA)
    + f", again as (select {_ORDER6}, {', '.join(f'''nullif({c}, '') as {c}''' for c in [*REPORT_KEYS, *SPREAD_CELLS])} from spread)"
    + _attached("again", _ORDER6, REPORT_KEYS, SPREAD_CELLS),
    "criteria_notes": "with one as (select 1)" + _notes(CRITERIA)
    + 'select "ArticleNumber", "NEW_CRIT", "VM_df2" from notes',
    "header_on_change": """
select o_orderkey, o_custkey,
  case when lag(o_orderstatus) over w is not distinct from o_orderstatus then '' else o_orderstatus end
    as o_orderstatus,
  case when lag(o_orderpriority) over w is not distinct from o_orderpriority then '' else o_orderpriority end
    as o_orderpriority
from orders window w as (order by o_custkey, o_orderkey)""",
    "row_level": """
select o_custkey, o_orderkey, engine, case when engine is not null then 'detail'
  when lead(1) over w is not null and lead(engine) over w is null then 'brand' else 'model' end as row_level
from (select *, nullif(o_orderstatus, 'O') as engine from orders) window w as (order by o_orderkey)""",
    "row_level_within": """
select o_custkey, o_orderkey, engine, case when engine is not null then 'detail'
  when lead(1) over w is not null and lead(engine) over w is null then 'brand' else 'model' end as row_level
from (select *, nullif(o_orderstatus, 'O') as engine from orders)
window w as (partition by o_custkey order by o_orderkey)""",
    "row_numbers": f"""
select {LINE5}, row_number() over (order by {LINE5}) - 1 as row_no from lineitem""",
    "shift_rows": """
select o_orderkey, lag(o_custkey, 2) over w as o_custkey, lag(o_orderstatus, 2) over w as o_orderstatus
from orders window w as (order by o_orderkey)""",
    "drop_tail": """
select o_orderkey, o_custkey, o_totalprice from orders
where o_orderkey not in (select o_orderkey from orders order by o_orderkey desc limit 2)""",
    "spread_lists": LISTS + _product("src", "rid", _SPREAD_KEYS, ["A", "N", "R"], ["month"])
    + _masked("m", "p2", "rid, i0, i1, i2", _SPREAD_KEYS, ["A", "N", "R", "month"])
    + f"\nselect {_SPREAD_OUT} from m group by all having count(*) = 1",
    "spread_lists_tail": LISTS + _TAIL_STAGES
    + _masked("m", "t2", "rid, i0, i1, i2", _SPREAD_KEYS, ["A", "N", "R", "month"])
    + f"\nselect {_SPREAD_OUT} from m group by all having count(*) = 1",
    "attach_criteria": FIT
    + _notes(f"""
  select case when l_partkey > 2 then "ArticleNumber" end as "ArticleNumber",
    nullif("VM_df2", '5-LOW') as "VM_df2", "NEW_CRIT", {LINE} from ({CRITERIA})""")
    + """
, src as (select seq, nullif(TypeName, '5-LOW') as label, VM, Engines,
    case when l_linenumber % 2 = 0 then ArticleNumber end as even_article,
    case when l_linenumber % 3 = 0 then ArticleNumber end as third_article,
    GenericArticle as kind from fit)"""
    + _attached("src", "seq", ["label", "VM", "Engines"], ["even_article", "third_article", "kind"]),
    "prefix_split": f"""
with lists as (select l_orderkey, string_agg({PREFIX} || cast(p_partkey as varchar), ', ' order by {LINE}) as article
  from lineitem join part on l_partkey = p_partkey group by l_orderkey)
select l_orderkey, 0 as page, {_buckets("article")} from lists""",
    "text_members": rf"""
select doc_id, cast(len(string_split(text, ',')) as int) as members,
  cast(len(list_distinct(string_split(text, ','))) as int) as distinct_members,
  array_to_string(list_filter(list_transform(string_split(text, ','),
    lambda y: regexp_replace(y, '^{_BLANK}+|{_BLANK}+$', '', 'g')),
    lambda x: starts_with(x, 'a') and not starts_with(x, 'an')), ', ') as picked
from documents""",
    "strip_text": rf"""
select conv_id, turn, regexp_replace(text, '^{_BLANK}+|{_BLANK}+$', '', 'g') as text from conversations""",
    "literal_replace": """
select doc_id, replace(replace(replace(replace(text, ' ', ',*,'), '*,', ''), ',*', ''), '*', '') as text
from documents""",
    "criteria_text": """
select event_id, case when event_id % 5 = 4
  then event_type || ', None: ' || cast(user_id as varchar) end as note from events""",
    "repeated_members": """
select o_custkey, count(distinct o_orderstatus) as distinct_members, cast(count(*) as bigint) as members
from orders group by o_custkey having count(distinct o_orderstatus) <> count(*)""",
    "repeated_articles": K + """
, k2 as (select * from k qualify row_number() over (
    partition by Name, VM, Engines, Year, HorsePowers, ArticleNumber order by seq) = 1)
select Name, VM, Engines, GenericArticle, count(distinct ArticleNumber) as distinct_members,
  cast(count(*) as bigint) as members
from k2 group by Name, VM, Engines, GenericArticle having count(distinct ArticleNumber) <> count(*)""",
    "first_rows": """
select o_totalprice, o_orderkey, o_custkey from orders order by o_totalprice, o_orderkey limit 10""",
    "barcode_lists": """
select row_number() over (order by o_custkey) - 1 as rank, o_custkey, 0 as page,
  '[' || string_agg(cast(o_orderkey as varchar), ', ' order by o_orderkey) || ']' as o_orderkey
from orders group by o_custkey""",
    "paged_lists": f"""
select l_returnflag, cast(page as int) as page,
  '[' || string_agg(cast(l_partkey as varchar), ', ' order by {LINE}) || ']' as parts
from (select *, (row_number() over (partition by l_returnflag order by {LINE}) - 1) // 1000 as page
      from lineitem)
group by l_returnflag, page""",
    "sort_links": """
with links as (select l_partkey as "ART_ID", case when l_suppkey > 5 then l_suppkey end as "VEH_TYPE_NO",
  cast(l_orderkey as varchar) as "ART_NUM" from lineitem)
select row_number() over (order by "ART_ID" nulls last, "VEH_TYPE_NO" nulls last, "ART_NUM" nulls last) - 1 as rank, *
from links""",
    "unquoted_lines": """
select 'ART_ID;VEH_TYPE_NO;ART_NUM' as line union all
select cast(l_partkey as varchar) || ';'
  || coalesce(cast(case when l_suppkey > 5 then l_suppkey end as varchar), '') || ';'
  || cast(l_orderkey as varchar) from lineitem""",
    "clean_vehicles": """
select row_number() over (order by p_brand nulls last, p_partkey nulls last) - 1 as rank, p_brand as "VEH_BRAND", p_partkey as "VEH_TYPE_NO",
  coalesce(cast(cast(trunc(nullif(p_retailprice, 900.0)) as bigint) as varchar), '') as "VEH_MODEL_NO"
from part""",
    "distinct_values": "select distinct p_type from part",
    "csv_round_trip": """
select c_custkey, c_name || ' ";" ' as c_name, c_nationkey, c_acctbal, c_mktsegment from customer""",
    "parquet_round_trip": "select * from supplier",
    # The file stands in the order of its key.
    "file_order": "select o_orderkey, row_number() over (order by o_orderkey) - 1 as row_no from orders",
    "article_files_parts": "select o_orderkey as \"ART_ID\", o_orderpriority || '.png' as \"FILE_NAME\","
    " cast(o_custkey % 5 as int) as \"FILE_ORDER\" from orders",
    "quoted_records": """select doc_id, '"' || replace(text, ' ', chr(10) || '";' || chr(10)) as text, lang, source from documents""",
    "article_files": "select o_orderkey as \"ART_ID\", o_orderpriority || '.jpg' as \"FILE_NAME\","
    " cast(o_custkey % 7 as int) as \"FILE_ORDER\" from orders",
}
