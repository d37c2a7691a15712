"""The same results in plain SQL, written independently of the Spark queries.

Snapshots are window functions, roll-forwards are three set differences and the
closure is a recursive query, so agreement is more than a tautology.
"""

from __future__ import annotations

from termledger import constants as K
from termledger.plans import queries as Q

# The digit tables by their rules, apart from those of the engine: the group of
# the turns 0-4 and flips 5-9 of a pentagon, powers of one permutation, inverses.
def _turn_or_flip(x: int, y: int) -> int:
    turned = x % 5 + (y % 5 if x < 5 else -(y % 5))
    return turned % 5 + (5 if (x < 5) != (y < 5) else 0)


FIRST_PERMUTATION = "1576283094"
MULTIPLICATION = ["".join(str(_turn_or_flip(x, y)) for y in range(10)) for x in range(10)]
PERMUTATION = ["0123456789"]
for _ in range(7):
    PERMUTATION.append("".join(PERMUTATION[-1][int(digit)] for digit in FIRST_PERMUTATION))
INVERSE = "".join(str(MULTIPLICATION[x].index("0")) for x in range(10))

# View texts: name -> (views it needs, text).
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}


def _view(name: str, text: str, *needs: str) -> None:
    VIEWS[name] = (needs, text)


_view(
    "fx_concept",
    """select p_partkey as concept_id, date '2018-11-01' as effective_time,
  case when p_size % 10 = 0 then 0 else 1 end as active, 21000210109 as module_id,
  case when p_retailprice > 1000 then 900000000000073002 else 900000000000074008 end as definition_status_id
from part""",
)
_view(
    "fx_description",
    """select p_partkey * 10 + k as description_id, p_partkey as concept_id,
  case when (p_partkey + k) % 11 = 0 then 0 else 1 end as active, 'en' as language_code,
  case when k = 1 then 900000000000003001 else 900000000000013009 end as type_id,
  case when k = 1 then concat(p_name, ' (', lower(p_type), ')') when k = 2 then p_name else p_brand end as term,
  case when k = 3 then 900000000000017005 else 900000000000448009 end as case_significance_id
from part cross join (select 1 as k union all select 2 union all select 3) t""",
)
_view(
    "fx_dialect",
    """select p_partkey * 10 + k as description_id,
  case when k = 2 then 900000000000548007 else 900000000000549004 end as acceptability_id
from part cross join (select 2 as k union all select 3) t
where p_partkey % 7 <> 0""",
)
_view(
    "fx_dialect_all",
    """select p_partkey * 10 + k as description_id,
  case when k = 2 then 900000000000548007 else 900000000000549004 end as acceptability_id
from part cross join (select 2 as k union all select 3) t""",
)
_view(
    "fx_relationship",
    """select l_orderkey * 10 + l_linenumber as relationship_id, min(l_partkey) as source_id,
  min(l_suppkey) as destination_id, min(case when l_returnflag = 'R' then 0 else 1 end) as active,
  min(case when l_linenumber % 2 = 0 then 116676008 else 363698007 end) as type_id,
  min(case when l_linestatus = 'F' then 900000000000011006 else 900000000000010007 end) as characteristic_type_id
from lineitem group by l_orderkey, l_linenumber""",
)
_view(
    "fx_is_a",
    """select distinct sub_concept_id, super_concept_id from (
  select p_partkey as sub_concept_id, cast(floor(p_partkey / 2) as bigint) as super_concept_id from part where p_partkey > 0
  union all
  select p_partkey, cast(floor(p_partkey / 3) as bigint) from part where p_partkey > 0) t""",
)
_view(
    "fx_map_full",
    """select md5(concat_ws('|', cast(l_partkey as string), cast(l_suppkey as string))) as member_id,
  cast(l_shipdate as date) as effective_date, min(case when l_returnflag = 'R' then 0 else 1 end) as active,
  l_suppkey % 5 as refset_id, l_partkey as concept_id, cast(l_suppkey as string) as map_target
from lineitem
group by l_partkey, l_suppkey, cast(l_shipdate as date)""",
)
_view(
    "fx_map_active",
    """select distinct code % 5 as refset_id, l_partkey as concept_id, cast(code as string) as map_target
from (select *, case when l_linenumber = 7 then l_suppkey + 1000000000 else l_suppkey end as code from lineitem) t
where l_quantity > 15""",
)
_view(
    "fx_map_pairs",
    """select distinct l_suppkey % 5 as refset_id, l_partkey as concept_id, cast(l_suppkey as string) as map_target
from lineitem""",
)
_view(
    "fx_lang_customers",
    """select c_custkey % 2 as refset_id, c_custkey as description_id,
  case when c_mktsegment = 'BUILDING' then 900000000000548007 else 900000000000549004 end as acceptability_id
from customer""",
)
_view(
    "fx_lang_full",
    """select md5(concat_ws('|', cast(o_custkey % 2 as string), cast(o_custkey as string))) as member_id,
  cast(o_orderdate as date) as effective_date, min(case when o_orderstatus = 'F' then 0 else 1 end) as active,
  o_custkey % 2 as refset_id, o_custkey as description_id,
  max(case when o_orderpriority in ('1-URGENT', '2-HIGH') then 900000000000548007 else 900000000000549004 end) as acceptability_id
from orders
group by o_custkey, cast(o_orderdate as date)""",
)
_view(
    "fx_lang_active",
    """select c_custkey % 2 as refset_id,
  case when c_custkey % 10 = 0 then c_custkey + 1000000000 else c_custkey end as description_id,
  case when c_mktsegment = 'BUILDING' then 900000000000548007 else 900000000000549004 end as acceptability_id
from customer where c_acctbal > 0""",
)
_view(
    "fx_refset_full",
    "select member_id, effective_date, active, refset_id, description_id as concept_id from fx_lang_full",
    "fx_lang_full",
)
_view(
    "fx_refset_active",
    """select md5(concat_ws('|', 'tool', cast(c_custkey as string))) as member_id,
  c_custkey % 2 as refset_id,
  case when c_custkey % 10 = 0 then c_custkey + 1000000000 else c_custkey end as concept_id
from customer where c_acctbal > 0""",
)
_view(
    "fx_dep",
    """select md5(s_name) as dep_id, d.effective_date, 1 as active, 21000210109 as module_id,
  900000000000534007 as refset_id, s_suppkey as referenced_component_id,
  d.effective_date as source_effective_date, d.effective_date as target_effective_date
from supplier cross join (select date '2018-08-01' as effective_date union all select date '2018-11-01') d""",
)
_view(
    "fx_read_term",
    """select lpad(cast(p_partkey as string), cast(greatest(5, length(cast(p_partkey as string))) as integer), '0') as read_code, '00' as term_code,
  case when p_partkey % 3 = 0 then '' else p_type end as term_30,
  case when p_partkey % 4 = 0 then null else p_name end as term_60,
  case when p_partkey % 5 = 0 then p_brand else '' end as term_198
from part""",
)
_view(
    "fx_ids",
    """select concat(cast(c_custkey + 1 as string), '100021010', cast(c_custkey % 10 as string)) as sctid
from customer""",
)


def _latest(full: str) -> str:
    return f"""select * exclude (version_rank) from (
  select *, row_number() over (partition by member_id order by effective_date desc) as version_rank
  from {full}) ranked where version_rank = 1"""


def _uuid(*key: str) -> str:
    """Name-based UUID of a key."""
    parts = " || ".join(f"length(cast({part} as string)) || ':' || cast({part} as string)" for part in key)
    d = f"md5({parts})"
    return (
        f"substr({d}, 1, 8) || '-' || substr({d}, 9, 4) || '-3' || substr({d}, 14, 3) || '-8' || "
        f"substr({d}, 18, 3) || '-' || substr({d}, 21, 12)"
    )


_view("map_snapshot", _latest("fx_map_full"), "fx_map_full")
_view("lang_snapshot", _latest("fx_lang_full"), "fx_lang_full")
_view("refset_snapshot", _latest("fx_refset_full"), "fx_refset_full")
_view("active_concept", "select * from fx_concept where active = 1", "fx_concept")
_view(
    "fsn",
    """select concept_id, description_id as fully_specified_name_description_id,
  term as fully_specified_name,
  case when case_significance_id = 900000000000017005 then 1 else 0 end as fully_specified_name_case_significant
from fx_description where active = 1 and type_id = 900000000000003001""",
    "fx_description",
)
_view(
    "pt",
    """select concept_id, description_id as preferred_term_description_id, term as preferred_term,
  case when case_significance_id = 900000000000017005 then 1 else 0 end as preferred_term_case_significant
from fx_description join fx_dialect using (description_id)
where active = 1 and language_code = 'en' and type_id = 900000000000013009
  and acceptability_id = 900000000000548007""",
    "fx_description",
    "fx_dialect",
)
_view(
    "syn",
    """select concept_id, description_id as synonym_description_id, term as synonym_term,
  case when case_significance_id = 900000000000017005 then 1 else 0 end as synonym_case_significant
from fx_description join fx_dialect using (description_id)
where active = 1 and language_code = 'en' and type_id = 900000000000013009
  and acceptability_id = 900000000000549004""",
    "fx_description",
    "fx_dialect",
)
_view(
    "concept_any",
    """select c.concept_id, c.effective_time as concept_effective_time, c.active as concept_active,
  f.fully_specified_name_description_id, f.fully_specified_name, f.fully_specified_name_case_significant,
  p.preferred_term_description_id, p.preferred_term, p.preferred_term_case_significant,
  case when c.definition_status_id = 900000000000073002 then 1 else 0 end as fully_defined
from fx_concept c join fsn f using (concept_id) join pt p using (concept_id)""",
    "fx_concept",
    "fsn",
    "pt",
)
_view(
    "concept_named",
    """select a.*, r.read_code as ctv3_code from concept_any a
left join fx_read_term r on cast(r.read_code as bigint) = a.concept_id where a.concept_active = 1""",
    "concept_any",
    "fx_read_term",
)
_view(
    "relationship_active",
    """select relationship_id, source_id, destination_id, type_id,
  case when characteristic_type_id = 900000000000011006 then 1 else 0 end as is_inferred
from fx_relationship where active <> 0""",
    "fx_relationship",
)
_view(
    "read_term",
    """select distinct read_code, term_code as read_term_code,
  case when rtrim(coalesce(term_198, '')) <> '' then term_198
    when rtrim(coalesce(term_60, '')) <> '' then term_60 else coalesce(term_30, '') end as read_term
from fx_read_term""",
    "fx_read_term",
)

_RELEASE = f"date '{Q.RELEASE}'"
_STAMP = f"{_RELEASE} as effective_date"
_MODULE = f"cast({K.EXTENSION_MODULE} as bigint) as module_id"


def _difference(state: str, other: str, key: list[str], columns: str, where: str, member: str, active: int):
    match = " and ".join(f"o.{c} = s.{c}" for c in key)
    return f"""select {member} as member_id, {_STAMP}, {active} as active, {_MODULE}, {columns}
from {state} s where {where} not exists (select 1 from {other} o where {match})"""


def _release(snapshot: str, target: str, key: list[str], values: list[str], new_id: str):
    """The three statements of a roll-forward."""
    columns = ", ".join(f"s.{c}" for c in [*key, *values])
    updated_columns = ", ".join([f"s.{c}" for c in key] + [f"t.{c}" for c in values])
    match = " and ".join(f"t.{c} = s.{c}" for c in key)
    differs = "".join(f" or s.{c} <> t.{c}" for c in values)
    return (
        _difference(snapshot, target, key, columns, "s.active = 1 and", "s.member_id", 0),
        _difference(target, snapshot, key, columns, "", new_id, 1),
        f"""select s.member_id, {_STAMP}, 1 as active, {_MODULE}, {updated_columns}
from {snapshot} s join {target} t on {match} where s.active = 0{differs}""",
    )


for _name, _snapshot, _target, _key, _values, _new_id in (
    ("map", "map_snapshot", "fx_map_active", Q.MAP_KEY, [], _uuid(*[f"s.{c}" for c in Q.MAP_KEY])),
    (
        "lang",
        "lang_snapshot",
        "fx_lang_active",
        Q.LANGUAGE_KEY,
        ["acceptability_id"],
        _uuid(*[f"s.{c}" for c in Q.LANGUAGE_KEY]),
    ),
    ("refset", "refset_snapshot", "fx_refset_active", Q.REFSET_KEY, [], "s.member_id"),
):
    for _kind, _text in zip(
        ("inactivated", "new", "updated"),
        _release(_snapshot, _target, _key, _values, _new_id),
        strict=True,
    ):
        _view(f"{_name}_{_kind}", _text, _snapshot, _target)
    _view(
        f"{_name}_delta",
        " union all ".join(f"select * from {_name}_{k}" for k in ("inactivated", "new", "updated")),
        *[f"{_name}_{k}" for k in ("inactivated", "new", "updated")],
    )
    _view(
        f"{_name}_after",
        f"""select * from fx_{_name}_full union all by name
select * exclude (module_id) from {_name}_delta""",
        f"fx_{_name}_full",
        f"{_name}_delta",
    )


def _closure(edges: str) -> str:
    return f"""closure as (
  select sub_concept_id, super_concept_id from {edges}
  union
  select c.sub_concept_id, e.super_concept_id from closure c
  join {edges} e on e.sub_concept_id = c.super_concept_id)"""


def _digits(text: str, offset: int) -> str:
    """Group product over the digits of a text, from the right."""
    permutation, table = "".join(PERMUTATION), "".join(MULTIPLICATION)
    step = (
        f"cast(substr('{permutation}', ((i + {offset}) % 8) * 10 + "
        f"cast(substr(reverse({text}), i + 1, 1) as integer) + 1, 1) as integer)"
    )
    return (
        f"list_reduce(list_prepend(0, list_transform(range(length({text})), lambda i: {step})), "
        f"lambda c, m: cast(substr('{table}', c * 10 + m + 1, 1) as integer))"
    )


def _sql(body: str, *views: str, recursive: str = "") -> str:
    ordered: list[str] = []

    def need(name: str) -> None:
        if name not in ordered:
            for other in VIEWS[name][0]:
                need(other)
            ordered.append(name)

    for name in views:
        need(name)
    parts = [f"{name} as ({VIEWS[name][1]})" for name in ordered]
    if recursive:
        parts.append(recursive)
    prefix = f"with {'recursive ' if recursive else ''}{', '.join(parts)} " if parts else ""
    return prefix + body


_LINE_ORDER = (
    "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, "
    "l_linestatus, l_shipdate"
)
_LOW, _HIGH = Q.OWN_RANGE
_TAGS = " and ".join(f"fully_specified_name not like '% {tag}'" for tag in Q.NAME_TAGS)
_NAMES = ", ".join(f"({refset}, '{name}')" for refset, name in Q.REFSET_NAMES.items())
_DATES = ", ".join(f"(date '{day}')" for day in Q.RELEASE_DATES)


def _descriptors(parent: int, rows: list[tuple[int, int, int]]) -> str:
    values = ", ".join(str(row) for row in rows)
    identity = _uuid(str(K.DESCRIPTOR_REFSET), "r.source_id", "a.attribute_order")
    return f"""select {identity} as attribute_id, {_STAMP}, 1 as active, {_MODULE},
  cast({K.DESCRIPTOR_REFSET} as bigint) as refset_id, r.source_id as referenced_component_id,
  cast(a.attribute_description as bigint) as attribute_description,
  cast(a.attribute_type as bigint) as attribute_type, a.attribute_order
from (select distinct source_id from fx_relationship where destination_id = {parent}) r
join active_concept c on c.concept_id = r.source_id
cross join (values {values}) a(attribute_description, attribute_type, attribute_order)"""


ORACLE: dict[str, str] = {
    "scan_all": "select * from part",
    "literal_rows": _sql(
        f"""select refset_id, n, refset_name
from (select refset_id, count(*) as n from fx_map_full group by refset_id) c
join (values {_NAMES}) t(refset_id, refset_name) using (refset_id)""",
        "fx_map_full",
    ),
    # Number the lines; in each step keep those that come first under both keys,
    # pass on those that no kept line blocks.
    "load_unique": """with recursive numbered as (
  select *, row_number() over (order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
    l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) as line,
    l_orderkey || '-' || l_linenumber as a, l_partkey || '-' || l_suppkey as b from lineitem
), steps as (
  select line, a, b, 0 as kept from numbered
  union all
  select line, a, b, flag from (
    select *, max(flag) over (partition by a) as by_a, max(flag) over (partition by b) as by_b from (
      select line, a, b, case when line = min(line) over (partition by a) and line = min(line) over (partition by b)
        then 1 else 0 end as flag from steps where kept = 0) f) g
  where flag = 1 or (by_a = 0 and by_b = 0)
)
select n.* exclude (line, a, b) from numbered n join steps s using (line) where s.kept = 1""",
    "dedupe_first": f"""select * exclude (line_rank) from (
  select *, row_number() over (partition by l_orderkey, l_linenumber order by {_LINE_ORDER}) as line_rank
  from lineitem) t where line_rank = 1""",
    "project_rename": _sql(
        "select concept_id, description_id as synonym_description_id, term as synonym_term from fx_description",
        "fx_description",
    ),
    "literal_columns": _sql(
        f"""select {_STAMP}, 1 as active, {_MODULE}, refset_id, concept_id, map_target
from fx_map_pairs""",
        "fx_map_pairs",
    ),
    "case_flags": _sql(
        """select description_id,
  case when type_id = 900000000000003001 then 1 else 0 end as is_fsn,
  case when case_significance_id = 900000000000017005 then 1 else 0 end as case_significant,
  case when type_id = 900000000000013009 and active = 1 then 1 else 0 end as is_active_synonym
from fx_description""",
        "fx_description",
    ),
    "filter_eq": _sql(f"select * from fx_map_full where refset_id = {Q.SAMPLE_REFSET}", "fx_map_full"),
    "filter_and": _sql(
        "select * from fx_description where active = 1 and language_code = 'en' and type_id = 900000000000013009",
        "fx_description",
    ),
    "filter_or_changed": _sql(
        """select member_id, active, refset_id, description_id, s.acceptability_id,
  t.acceptability_id as new_acceptability_id
from lang_snapshot s join fx_lang_active t using (refset_id, description_id)
where active = 0 or s.acceptability_id <> t.acceptability_id""",
        "lang_snapshot",
        "fx_lang_active",
    ),
    "filter_ne": _sql(
        "select * from fx_description where type_id <> 900000000000003001", "fx_description"
    ),
    "filter_not_between": _sql(
        f"select * from fx_description where description_id not between {_LOW} and {_HIGH}",
        "fx_description",
    ),
    "filter_not_like": _sql(f"select * from fsn where {_TAGS}", "fsn"),
    "filter_truthy": _sql("select * from fx_relationship where active <> 0", "fx_relationship"),
    "component_history": _sql(
        f"select * from fx_map_full where concept_id = {Q.SAMPLE_CONCEPT} order by effective_date, active",
        "fx_map_full",
    ),
    "role_view": _sql(
        """select concept_id as finding_site_concept_id,
  fully_specified_name as finding_site_fully_specified_name from concept_named""",
        "concept_named",
    ),
    "natural_join": _sql(
        "select * from fx_description natural join fx_dialect_all", "fx_description", "fx_dialect_all"
    ),
    "natural_join_chain": _sql(
        "select * from fx_concept natural join fsn natural join pt", "fx_concept", "fsn", "pt"
    ),
    "semi_join": _sql(
        "select m.* from fx_map_pairs m where concept_id in (select concept_id from active_concept)",
        "fx_map_pairs",
        "active_concept",
    ),
    "cross_join": _sql(
        f"""select module_id, effective_date
from (select distinct refset_id as module_id from fx_map_full) m
cross join (values {_DATES}) d(effective_date)""",
        "fx_map_full",
    ),
    "left_enrich": _sql(
        """select d.description_id, d.concept_id, d.term, cast(a.acceptability_id as string) as acceptability_id
from fx_description d left join fx_dialect a on a.description_id = d.description_id""",
        "fx_description",
        "fx_dialect",
    ),
    "anti_join": _sql(
        """select s.* from map_snapshot s
left join fx_map_active a on a.refset_id = s.refset_id and a.concept_id = s.concept_id and a.map_target = s.map_target
where s.active = 1 and a.concept_id is null""",
        "map_snapshot",
        "fx_map_active",
    ),
    "anti_join_not_exists": _sql(
        """select * from fx_refset_active a where not exists (
  select 1 from refset_snapshot b where b.refset_id = a.refset_id and b.concept_id = a.concept_id)""",
        "fx_refset_active",
        "refset_snapshot",
    ),
    "two_hop_edges": _sql(
        """select distinct a.sub_concept_id, b.super_concept_id
from fx_is_a a join fx_is_a b on a.super_concept_id = b.sub_concept_id""",
        "fx_is_a",
    ),
    "subset_violations": _sql(
        """select * from fx_map_active a where not exists (select 1 from fx_map_full b
  where b.refset_id = a.refset_id and b.concept_id = a.concept_id and b.map_target = a.map_target)""",
        "fx_map_active",
        "fx_map_full",
    ),
    "count_global": _sql("select count(*) as n from fx_map_full", "fx_map_full"),
    "count_grouped": _sql(
        "select refset_id, active, count(*) as n from fx_map_full group by refset_id, active", "fx_map_full"
    ),
    "count_distinct": _sql(
        """select refset_id, count(*) as n, count(distinct concept_id) as n_concepts
from fx_map_full group by refset_id""",
        "fx_map_full",
    ),
    "max_by_key": _sql(
        "select member_id, max(effective_date) as effective_date from fx_map_full group by member_id",
        "fx_map_full",
    ),
    "max_length": _sql(
        """select max(strlen(term_60)) as max_length_term_60, max(strlen(term_198)) as max_length_term_198
from fx_read_term""",
        "fx_read_term",
    ),
    "having_alias": _sql(
        """select refset_id, concept_id, count(distinct member_id) as n
from fx_map_full group by refset_id, concept_id having n > 1""",
        "fx_map_full",
    ),
    "select_distinct": _sql(
        "select distinct type_id, characteristic_type_id, active from fx_relationship", "fx_relationship"
    ),
    "ordered_history": _sql(
        "select * from fx_map_full order by refset_id, concept_id, effective_date, member_id", "fx_map_full"
    ),
    "union_distinct": _sql(
        """select concept_id, 1 as assumed_active from fx_map_full
union select concept_id, active from fx_concept""",
        "fx_map_full",
        "fx_concept",
    ),
    "append_union": _sql("select * from map_after", "map_after"),
    "split_code": _sql(
        f"""select member_id, concept_id, substr(map_target, 1, 5) as read_code,
  substr(map_target, 6, 2) as read_term_code, effective_date, active
from map_snapshot where refset_id = {Q.SAMPLE_REFSET}""",
        "map_snapshot",
    ),
    "join_code": _sql(
        "select read_code, read_code || term_code as map_target, read_code || term_60 as labelled from fx_read_term",
        "fx_read_term",
    ),
    "strip_cr": _sql(
        f"""select concept_id, replace(map_target || chr(13) || member_id || chr(13), chr(13), '') as ctv3_code
from fx_map_full where refset_id = {Q.SAMPLE_REFSET}""",
        "fx_map_full",
    ),
    "first_non_empty": _sql("select * from read_term", "read_term"),
    "nzmt_style_map": _sql(
        f"""select concept_id, map_target as mp_id from map_snapshot
where refset_id = {Q.SAMPLE_REFSET} and active = 1""",
        "map_snapshot",
    ),
    "member_ids": _sql(f"select *, {_uuid(*Q.MAP_KEY)} as member_id from fx_map_pairs", "fx_map_pairs"),
    "export_projection": _sql(
        f"""select member_id as id, strftime(effective_date, '%Y%m%d') as "effectiveTime", active,
  cast({K.EXTENSION_MODULE} as bigint) as "moduleId", refset_id as "refsetId",
  concept_id as "referencedComponentId", map_target as "mapTarget" from fx_map_full""",
        "fx_map_full",
    ),
    "snapshot_map": _sql("select * from map_snapshot", "map_snapshot"),
    "snapshot_lang": _sql("select * from lang_snapshot", "lang_snapshot"),
    "snapshot_simple_refset": _sql("select * from refset_snapshot", "refset_snapshot"),
    "snapshot_asof": _sql(
        _latest(f"(select * from fx_map_full where effective_date <= date '{Q.AS_OF}') h"), "fx_map_full"
    ),
    "delta_map": _sql(
        f"select * from fx_map_full where effective_date = date '{Q.DELTA_DAY}'", "fx_map_full"
    ),
    "rf_map_inactivated": _sql("select * from map_inactivated", "map_inactivated"),
    "rf_map_new": _sql("select * from map_new", "map_new"),
    "rf_map_reactivated": _sql("select * from map_updated", "map_updated"),
    "rf_map_snapshot": _sql(_latest("map_after"), "map_after"),
    "rf_lang_inactivated": _sql("select * from lang_inactivated", "lang_inactivated"),
    "rf_lang_new": _sql("select * from lang_new", "lang_new"),
    "rf_lang_updated": _sql("select * from lang_updated", "lang_updated"),
    "rf_lang_snapshot": _sql(_latest("lang_after"), "lang_after"),
    "rf_refset_del": _sql("select * from refset_inactivated", "refset_inactivated"),
    "rf_refset_add": _sql("select * from refset_new", "refset_new"),
    "rf_refset_upd": _sql("select * from refset_updated", "refset_updated"),
    "rf_refset_snapshot": _sql(_latest("refset_after"), "refset_after"),
    "carry_forward": _sql(
        f"""select * from fx_dep union all
select dep_id, date '{Q.CARRY_TO}', 1, module_id, refset_id, referenced_component_id,
  date '{Q.CARRY_TO}', date '{Q.CARRY_TARGET}'
from fx_dep where effective_date = date '{Q.CARRY_FROM}'""",
        "fx_dep",
    ),
    "discover_refsets": _sql(
        f"select distinct source_id as refset_id from fx_relationship where destination_id = {Q.SAMPLE_PARENT}",
        "fx_relationship",
    ),
    "refset_descriptors": _sql(
        _descriptors(Q.SAMPLE_PARENT, [(449608002, 900000000000461009, 0)])
        + " union all "
        + _descriptors(
            Q.SAMPLE_PARENT + 1,
            [(900000000000500006, 900000000000461009, 0), (900000000000499002, 900000000000465000, 1)],
        ),
        "fx_relationship",
        "active_concept",
    ),
    "map_target_set": _sql(
        f"""select distinct t.* from (
  select cast({K.MAP_READ_TO_CONCEPT} as bigint) as refset_id, cast(read_code as bigint) as concept_id,
    concat(read_code, term_code) as map_target from fx_read_term
  union all
  select cast({K.MAP_CONCEPT_TO_READ} as bigint), cast(read_code as bigint), concat(read_code, term_code)
  from fx_read_term
  union all
  select cast({K.MAP_MEDICINES} as bigint), concept_id, cast(refset_id as string) from fx_map_pairs) t
join active_concept c on c.concept_id = t.concept_id""",
        "fx_read_term",
        "fx_map_pairs",
        "active_concept",
    ),
    "lang_target_set": _sql(
        f"""select cast({K.LANGUAGE_ENGLISH} as bigint) as refset_id, description_id, acceptability_id
from fx_dialect_all
union select cast({K.LANGUAGE_PATIENT_FRIENDLY} as bigint), description_id, 900000000000548007
from fx_lang_customers
union select cast({K.LANGUAGE_ENGLISH} as bigint), description_id, 900000000000548007
from fx_description where type_id = 900000000000003001
  and description_id not between {_LOW} and {_HIGH}""",
        "fx_dialect_all",
        "fx_lang_customers",
        "fx_description",
    ),
    "is_a_closure": _sql("select * from closure", "fx_is_a", recursive=_closure("fx_is_a")),
    "descendants_of": _sql(
        f"select sub_concept_id from closure where super_concept_id = {Q.SAMPLE_ANCESTOR}",
        "fx_is_a",
        recursive=_closure("fx_is_a"),
    ),
    "ancestors_of": _sql(
        f"select super_concept_id from closure where sub_concept_id = {Q.SAMPLE_CONCEPT}",
        "fx_is_a",
        recursive=_closure("fx_is_a"),
    ),
    "closure_cycles": _sql(
        "select * from closure where sub_concept_id = super_concept_id",
        "fx_is_a",
        recursive="""edges as (select sub_concept_id, super_concept_id from fx_is_a
  union all select super_concept_id, sub_concept_id from fx_is_a where super_concept_id = 0), """
        + _closure("edges"),
    ),
    "preferred_term": _sql("select * from pt", "pt"),
    "synonym_term": _sql("select * from syn", "syn"),
    "fully_specified_name": _sql("select * from fsn", "fsn"),
    "dialect_description": _sql(
        """select d.description_id, concept_id, type_id, term, case_significance_id, acceptability_id
from fx_description d join fx_dialect a on a.description_id = d.description_id""",
        "fx_description",
        "fx_dialect",
    ),
    "description_active": _sql(
        """select concept_id, d.description_id, term, case_significance_id,
  case when type_id = 900000000000003001 then 1 else 0 end as is_fsn,
  case when type_id = 900000000000013009 and coalesce(acceptability_id, 0) = 900000000000548007
    then 1 else 0 end as is_pt
from fx_description d left join fx_dialect a on a.description_id = d.description_id
where active = 1 and language_code = 'en'""",
        "fx_description",
        "fx_dialect",
    ),
    "concept": _sql("select * from concept_named", "concept_named"),
    "concept_active_or_inactive": _sql("select * from concept_any", "concept_any"),
    "concept_synonym": _sql("select * from concept_named natural join syn", "concept_named", "syn"),
    "attribute_pairs": _sql(
        """select distinct source_id as concept_id, destination_id as assoc_morph_concept_id
from relationship_active where type_id = 116676008""",
        "relationship_active",
    ),
    "finding_site_pairs": _sql(
        """select distinct source_id as concept_id, destination_id as finding_site_concept_id
from relationship_active where type_id = 363698007""",
        "relationship_active",
    ),
    "active_relationship": _sql("select * from relationship_active", "relationship_active"),
    "fd_violations": _sql(
        """select refset_id, concept_id, count(*) as n
from (select distinct refset_id, concept_id, member_id from fx_map_full) a
group by refset_id, concept_id having n > 1""",
        "fx_map_full",
    ),
    "dq_duplicates": _sql(
        "select refset_id, concept_id, count(*) as n from fx_map_full group by refset_id, concept_id having n > 1",
        "fx_map_full",
    ),
    "dq_orphans": _sql(
        """select c.* from fx_lang_full c left join fx_lang_active p on p.description_id = c.description_id
where p.description_id is null""",
        "fx_lang_full",
        "fx_lang_active",
    ),
    "dq_orphans_composite": _sql(
        """select * from fx_map_full c where not exists (select 1 from fx_lang_full p
  where p.refset_id = c.refset_id and p.effective_date = c.effective_date)""",
        "fx_map_full",
        "fx_lang_full",
    ),
    "dq_check": _sql("select * from read_term where not (read_term <> '')", "read_term"),
    "dq_nulls": _sql("select * from fx_read_term where term_30 is null or term_60 is null", "fx_read_term"),
    "date_profile": _sql(
        "select refset_id, effective_date, count(*) as n from fx_map_full group by refset_id, effective_date",
        "fx_map_full",
    ),
    "dq_inactive_refs": _sql(
        """select m.* from fx_map_pairs m left join active_concept c on c.concept_id = m.concept_id
where c.concept_id is null""",
        "fx_map_pairs",
        "active_concept",
    ),
    "active_counts": _sql(
        "select refset_id, count(*) as n from map_snapshot where active = 1 group by refset_id", "map_snapshot"
    ),
    "release_change_counts": _sql(
        "select refset_id, active, count(*) as n from map_delta group by refset_id, active", "map_delta"
    ),
    "reconcile_counts": _sql(
        """select 'source_rows' as name, count(*) as n from fx_lang_active
union all select 'present', count(*) from fx_lang_active
  where description_id in (select description_id from lang_snapshot where active = 1)
union all select 'missing', count(*) from fx_lang_active a
  where not exists (select 1 from lang_snapshot b where b.active = 1 and b.description_id = a.description_id)
union all select 'active_members', count(*) from lang_snapshot where active = 1""",
        "fx_lang_active",
        "lang_snapshot",
    ),
    "must_be_active": _sql(
        """select t.description_id, s.member_id,
  case when s.active is null then 'missing' else 'inactive' end as state
from fx_lang_active t left join lang_snapshot s on s.description_id = t.description_id
where s.active is null or s.active <> 1""",
        "fx_lang_active",
        "lang_snapshot",
    ),
    "pt_cardinality": _sql(
        """select refset_id, count(*) as n_members, count(distinct description_id) as n_descriptions
from lang_snapshot where active = 1 and acceptability_id = 900000000000548007 group by refset_id""",
        "lang_snapshot",
    ),
    "pt_per_concept": _sql(
        """select refset_id, c_nationkey as concept_id, count(*) as n
from lang_snapshot join customer on c_custkey = description_id
where active = 1 and acceptability_id = 900000000000548007
group by refset_id, c_nationkey having n > 1""",
        "lang_snapshot",
    ),
    "id_profile": _sql(
        f"""select distinct case when length(sctid) >= 10 then substr(sctid, length(sctid) - 9, 7) end as namespace_id,
  case when length(sctid) >= 3 then substr(sctid, length(sctid) - 2, 2) end as partition_id,
  {_digits('sctid', 0)} as check_digit
from fx_ids""",
        "fx_ids",
    ),
    "invalid_ids": _sql(f"select sctid from fx_ids where {_digits('sctid', 0)} <> 0", "fx_ids"),
    "generated_check_digits": _sql(
        f"""select sctid, body, cast(substr('{INVERSE}', {_digits('body', 1)} + 1, 1) as integer) as check_digit
from (select sctid, substr(sctid, 1, length(sctid) - 1) as body from fx_ids) t""",
        "fx_ids",
    ),
}
