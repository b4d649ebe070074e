"""The catalog's queries in DuckDB SQL, written from the definitions, not from the plans."""

from __future__ import annotations

from ..functions.model_output import PROMPT_HEAD, PROMPT_TAIL
from . import fixtures as fx

WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]"


def _text(value) -> str:
    return "cast(null as varchar)" if value is None else "'" + value.replace("'", "''") + "'"


def _pick(values, index: str) -> str:
    if any(isinstance(v, list) for v in values):
        items = ["cast([" + ", ".join(map(_text, v)) + "] as varchar[])" for v in values]
    else:
        items = [_text(v) for v in values]
    return f"([{', '.join(items)}])[cast({index} + 1 as integer)]"


def _clinical(name: str, table: str, key: str, text: str, title: str, journal: str) -> str:
    return f"""{name} as (
  select cast({key} as varchar) as pmid, {title} as title,
         {text} || ' ' || {_pick(fx.SENTENCES, f'{key} % 6')} as abstract_text,
         {journal} || '|Roe, R' as authors,
         case when {key} % 17 <> 0 then
           cast(date '2015-01-01' + cast({key} * 37 % 3650 as integer) as date) end as pub_date,
         {_pick(fx.SUBJECTS, f'{key} % 4')} as mesh_terms, {journal} as journal
  from {table})"""


ABSTRACTS = _clinical(
    "abstracts", "documents", "doc_id", "text",
    "'Study ' || cast(doc_id as varchar) || ' of ' || lang", "source",
)
PAGE_ABSTRACTS = _clinical("page_abstracts", "pages", "page_id", "html", "url", "'web'")


def _record(k: str) -> dict[str, str]:
    return {
        "tnm_stage": _pick(fx.STAGES, f"{k} % 4"),
        "treatment_modality": _pick(fx.TREATMENTS, f"{k} % 3"),
        "biomarkers": _pick(fx.BIOMARKERS, f"{k} % 5 % 3"),
        "sample_size": f"case when {k} % 6 <> 0 then {k} % 500 end",
        "cancer_type": _pick(fx.CANCERS, f"{k} % 3"),
    }


def _reviewed(k: str, record: dict[str, str] | None = None) -> dict[str, str]:
    r = record or _record(k)
    return {
        "tnm_stage": f"case when {k} % 5 = 0 then 'Stage II' when {k} % 5 = 1 "
        f"then ' ' || lower({r['tnm_stage']}) when {k} % 5 <> 2 then {r['tnm_stage']} end",
        "treatment_modality": f"case when {k} % 4 = 0 then ['Surgery', ' radiation'] "
        f"when {k} % 4 <> 1 then {r['treatment_modality']} end",
        "biomarkers": f"case when {k} % 3 = 0 then ['pd-l1', 'ebv dna', 'EBV DNA'] "
        f"else {r['biomarkers']} end",
        "sample_size": f"case when {k} % 7 = 0 then null when {k} % 7 < 3 "
        f"then ({r['sample_size']}) + {k} % 60 else {r['sample_size']} end",
        "cancer_type": f"case when {k} % 4 = 1 then upper({r['cancer_type']}) "
        f"when {k} % 4 = 2 then '' else {r['cancer_type']} end",
    }


def _columns(fields: dict[str, str], prefix: str = "") -> str:
    return ",\n         ".join(f"{sql} as {prefix}{name}" for name, sql in fields.items())


GOLD = f"""gold as (
  select cast(doc_id as varchar) as pmid, {_columns(_reviewed('doc_id'), 'g_')} from labels)"""

EXTRACTIONS = f"""extractions as (
  select cast(doc_id as varchar) as pmid, toxic = 0 as has_original,
         {_columns(_reviewed('doc_id'), 'f_')},
         {_columns({n: f'case when toxic = 0 then {c} end' for n, c in _record('doc_id').items()},
                   'o_')},
         case when doc_id % 10 <> 0 then cast(doc_id % 6 as double) / 5.0::double end
           as confidence_score,
         case when doc_id % 8 <> 0 then quality = 1 end as human_verified,
         case when quality = 1 then 'looks right' end as reviewer_notes
  from labels)"""

NOTES = """notes as (
  select cast(page_id as varchar) as pmid, url as summary_text from pages)"""

RECORD = ("tnm_stage", "treatment_modality", "biomarkers", "sample_size", "cancer_type")
LISTS = ("treatment_modality", "biomarkers")


def _joined(sql: str) -> str:
    return f"coalesce(array_to_string({sql}, '|'), '')"


def _flat(source: str, prefix: str = "") -> str:
    """Record columns with a prefix, lists as text, under plain or prefixed names."""
    return ", ".join(
        (_joined(source + f) if f in LISTS else source + f) + f" as {prefix}{f}" for f in RECORD
    )


def _any(column: str, *terms: str) -> str:
    return "(" + " or ".join(f"contains({column}, '{t}')" for t in terms) + ")"


def _rules(name: str, source: str) -> str:
    """Rule record of every row of ``source``; lists already joined to text."""

    def labels(lexicon: dict[str, tuple[str, ...]]) -> str:
        parts = [f"case when {_any('lower(abstract_text)', *t)} then '{label}' end"
                 for label, t in lexicon.items()]
        return f"concat_ws('|', {', '.join(parts)})"

    treatments = {
        "chemotherapy": ("chemotherapy", "cisplatin", "carboplatin", "gemcitabine",
                         "docetaxel", "5-fu"),
        "radiation": ("radiation", "radiotherapy", "imrt", "proton therapy"),
        "immunotherapy": ("immunotherapy", "checkpoint inhibitor", "pembrolizumab",
                          "nivolumab", "anti-pd"),
        "surgery": ("surgery", "surgical", "resection", "dissection"),
    }
    biomarkers = {
        "EBV DNA": ("ebv", "epstein-barr", "ebv dna"),
        "PD-L1": ("pd-l1", "programmed death-ligand"),
        "p53": ("p53", "tp53"),
        "VEGF": ("vegf", "vascular endothelial"),
        "HER2": ("her2", "erbb2"),
    }
    stage_code = "nullif(regexp_extract(abstract_text, '(T[0-4][a-b]?N[0-3]M[0-1])', 1), '')"
    stage_word = (
        "'Stage ' || upper(nullif(regexp_extract(abstract_text, "
        f"'(?i)stage{WS}+(I{{1,3}}V?[AB]?|[1-4][AB]?)', 1), ''))"
    )
    size = (
        f"nullif(regexp_extract(abstract_text, '(?i)([0-9]{{1,5}}){WS}*"
        "(?:patients|subjects|cases|participants|individuals)', 1), '')"
    )
    tumour = _any("lower(abstract_text)", "cancer", "carcinoma")
    return f"""{name} as (
  select *, coalesce({stage_code}, {stage_word}) as r_tnm_stage,
         {labels(treatments)} as r_treatment_modality,
         {labels(biomarkers)} as r_biomarkers,
         cast({size} as bigint) as r_sample_size,
         case when {_any('lower(abstract_text)', 'nasopharyngeal')}
                then 'Nasopharyngeal Carcinoma'
              when {_any('lower(abstract_text)', 'lung')} and {tumour} then 'Lung Cancer'
              when {_any('lower(abstract_text)', 'breast')} and {tumour} then 'Breast Cancer'
         end as r_cancer_type
  from {source})"""


_READ = {
    f: f"case when r_{f} = '' then cast([] as varchar[]) else string_split(r_{f}, '|') end"
    if f in LISTS else f"r_{f}"
    for f in RECORD
}
PAIRS = f"""{ABSTRACTS},
{_rules('rules', 'abstracts')},
pairs as (
  select pmid,
         {_columns(_READ, 'o_')},
         {_columns(_reviewed('cast(pmid as bigint)', _READ), 'f_')}
  from rules)"""


def _score(prefix: str, joined: bool = False) -> str:
    size = (lambda c: f"{c} <> ''") if joined else (lambda c: f"len({c}) > 0")
    tests = [
        f"{prefix}tnm_stage <> ''", size(prefix + "treatment_modality"),
        size(prefix + "biomarkers"), f"{prefix}sample_size <> 0", f"{prefix}cancer_type <> ''",
    ]
    return "(" + " + ".join(
        f"cast(coalesce({t}, false) as integer)" for t in tests
    ) + ")::double / 5.0::double"


def _plain(prefix: str, names=RECORD) -> str:
    return ", ".join(f"{prefix}{f} as {f}" for f in names)


def _strip(sql: str) -> str:
    return f"regexp_replace({sql}, '^{WS}+|{WS}+$', '', 'g')"


def _collapse(sql: str) -> str:
    untagged = f"regexp_replace({sql}, '<[^>]+>', '', 'g')"
    return f"trim(regexp_replace({untagged}, '{WS}+', ' ', 'g'))"


KEY_FINDING = f"""case when length(abstract_text) > 100 then {_strip(
    "list_filter(string_split(abstract_text, '.'), lambda s: length("
    + _strip("s") + ") > 20)[-1]")} end"""


def _note(prefix: str) -> str:
    def text(f: str, default: str) -> str:
        return f"coalesce(nullif({prefix}{f}, ''), '{default}')"

    def items(f: str, default: str) -> str:
        return f"coalesce(nullif(replace({prefix}{f}, '|', ', '), ''), '{default}')"

    cancer, stage = text("cancer_type", "oncology condition"), text("tnm_stage", "unspecified stage")
    treated = items("treatment_modality", "unspecified treatment")
    size = f"{prefix}sample_size"
    return f"""case when coalesce({size}, 0) <> 0
      then 'This study examined ' || cast({size} as varchar) || ' patients with ' || {stage}
           || ' ' || {cancer} || ', treated with ' || {treated} || '.'
      else 'This study investigated ' || {cancer} || ' (' || {stage}
           || '), with treatment involving ' || {treated} || '.' end
    || ' Biomarkers assessed: ' || {items('biomarkers', 'none reported')} || '.'
    || coalesce(' Key finding: ' || {KEY_FINDING} || '.', '')"""


def _norm(sql: str) -> str:
    return f"nullif(lower({_strip(sql)}), '')"


def _norm_set(sql: str) -> str:
    folded = f"list_transform(coalesce({sql}, cast([] as varchar[])), lambda x: {_norm('x')})"
    return f"list_sort(list_distinct(list_filter({folded}, lambda x: x is not null)))"


MATCHES = {
    **{f: f"({_norm('o_' + f)} is not distinct from {_norm('f_' + f)})"
       for f in ("tnm_stage", "cancer_type")},
    **{f: f"({_norm_set('o_' + f)} = {_norm_set('f_' + f)})" for f in LISTS},
    "sample_size": "(o_sample_size is not distinct from f_sample_size or coalesce("
    "abs(o_sample_size - f_sample_size) <= greatest(1, f_sample_size // 10), false))",
}
MATCHED = ", ".join(f"{MATCHES[f]} as {f}_match" for f in RECORD)
DIFFERING = "concat_ws('|', " + ", ".join(
    f"case when not {f}_match then '{f}' end" for f in RECORD) + ")"


def _with(*ctes: str, select: str) -> str:
    return "with " + ",\n".join(ctes) + "\n" + select


FLAGS = {
    "mentions_ebv": ("ebv", "epstein-barr", "ebv dna"),
    "mentions_pdl1": ("pd-l1", "programmed death-ligand"),
    "mentions_p53": ("p53", "tp53"),
    "mentions_chemotherapy": ("chemotherapy", "cisplatin", "carboplatin", "gemcitabine"),
    "mentions_radiation": ("radiation", "radiotherapy", "imrt"),
    "mentions_immunotherapy": ("immunotherapy", "checkpoint inhibitor", "pembrolizumab",
                               "nivolumab"),
}
FLAGGED = """flagged as (
  select pmid as abstract_id, journal, extract(year from pub_date) as publication_year,
         length(abstract_text) as abstract_length,
         case when lower(array_to_string(mesh_terms, ',')) like '%nasopharyngeal%'
                then 'Nasopharyngeal Carcinoma'
              when lower(array_to_string(mesh_terms, ',')) like '%lung neoplasm%'
                then 'Lung Cancer'
              when lower(array_to_string(mesh_terms, ',')) like '%breast neoplasm%'
                then 'Breast Cancer'
              else 'Other/Unspecified' end as cancer_type,
         """ + ",\n         ".join(
    "coalesce(" + " or ".join(f"abstract_text ilike '%{t}%'" for t in terms) + f", false) as {f}"
    for f, terms in FLAGS.items()) + """
  from abstracts where length(abstract_text) > 10)"""

QUEUE = f"""queue as (
  select e.pmid, substring(title, 1, 80) || '...' as title_preview,
         case when length(abstract_text) > 500 then substring(abstract_text, 1, 500) || '...'
              else abstract_text end as abstract_preview,
         {_flat('f_')}, confidence_score, human_verified, reviewer_notes, summary_text
  from extractions e join abstracts using (pmid) left join notes using (pmid))"""

DECISIONS = """decisions as (
  select cast(user_id as varchar) as pmid, ts, event_id,
         (['approve', 'reject', 'skip'])[cast(event_id % 3 + 1 as integer)] as action,
         event_id % 2 = 0 as has_edit, 'note ' || cast(event_id as varchar) as notes,
         'Stage ' || event_type as d_tnm_stage, 'surgery|radiation' as d_treatment_modality,
         '' as d_biomarkers, cast(trunc(value) as bigint) as d_size,
         'Lung Cancer' as d_cancer_type
  from events),
last_action as (
  select * from decisions where action <> 'skip'
  qualify row_number() over (partition by pmid order by ts desc, event_id desc) = 1),
last_edit as (
  select * from decisions where action = 'approve' and has_edit
  qualify row_number() over (partition by pmid order by ts desc, event_id desc) = 1)"""

# What each kind of model output must give: JSON record, or null where the rules apply.
_MODEL = [
    ("Stage II", "chemotherapy|surgery", "p53", 80, "Lung Cancer"),
    ("T1N0M0", "", "", 7, None),
    None,
    None,
    (None, "", "", None, None),
    None,
    None,
    None,
    (None, "", "", 100, None),
    (None, "", "", 100, ""),
    None,
    (None, "", "", 1, None),
    (None, "", "", None, "Other"),
    ("Stage I", "", "", None, None),
    ("Stage III", "", "", None, None),
    None,
]


def _model_rows() -> str:
    def sql(v):
        return "null" if v is None else str(v) if isinstance(v, int) else _text(v)

    rows = [
        f"({i}, {str(m is not None).lower()}, "
        + ", ".join(map(sql, m or (None,) * 5)) + ")"
        for i, m in enumerate(_MODEL)
    ]
    names = ", ".join(f"m_{f}" for f in RECORD)
    return f"model_rows(kind, ok, {names}) as (values {', '.join(rows)})"


def _prf(field: str, tp: str, fp: str, fn: str) -> str:
    p = "case when tp + fp > 0 then tp::double / (tp + fp) else 0.0::double end"
    r = "case when tp + fn > 0 then tp::double / (tp + fn) else 0.0::double end"
    return f"""select field, tp, fp, fn, p as "precision", r as recall,
       case when p + r > 0 then 2 * p * r / (p + r) else 0.0::double end as f1
from (select *, {p} as p, {r} as r from (
  select '{field}' as field, cast({tp} as bigint) as tp, cast({fp} as bigint) as fp,
         cast({fn} as bigint) as fn from scored))"""


SCORED = "scored as (select * from pairs join gold using (pmid))"


def _text_metrics(f: str) -> str:
    p, g = f"coalesce(o_{f}, '')", f"coalesce(g_{f}, '')"
    return _prf(
        f,
        f"count(*) filter ({p} <> '' and {g} <> '' and lower({p}) = lower({g}))",
        f"count(*) filter ({p} <> '' and ({g} = '' or lower({p}) <> lower({g})))",
        f"count(*) filter ({g} <> '' and {p} = '')",
    )


def _list_metrics(f: str) -> str:
    def folded(c):
        return (f"list_distinct(list_transform(coalesce({c}, cast([] as varchar[])), "
                "lambda x: lower(x)))")

    p, g = folded("o_" + f), folded("g_" + f)
    both = f"len(list_filter({p}, lambda x: list_contains({g}, x)))"
    return _prf(f, f"sum({both})", f"sum(len({p}) - {both})", f"sum(len({g}) - {both})")


_EVAL_SIZE = """select 'sample_size' as field, n, correct,
       case when n > 0 then correct::double / n else 0.0::double end as accuracy
from (select count(*) filter (g_sample_size is not null) as n,
             count(*) filter (g_sample_size is not null and o_sample_size is not null
               and abs(o_sample_size - g_sample_size) <= greatest(0.1 * g_sample_size, 1))
               as correct from scored)"""

_DECODED = "html"
for _name, _char in (("quot", "'\"'"), ("copy", "chr(169)"), ("middot", "chr(183)"), ("amp", "'&'")):
    # These names also count without their semicolon; the ampersand comes last.
    _DECODED = f"regexp_replace({_DECODED}, '&{_name};?', {_char}, 'g')"

_CLEANED = f"""select pmid, title, {_collapse("'<p>' || abstract_text || ' & more</p>'")}
         as abstract_text, authors,
       case when cast(pmid as bigint) % 19 = 0 then null else pub_date end as pub_date,
       {_joined('mesh_terms')} as mesh_terms, journal
from abstracts"""

def _dq(table: str, check: str, column: str, sql: str) -> str:
    return (f"select '{table}' as table_name, '{check}' as check_name, "
            f"'{column}' as column_name, n as failures, n = 0 as passed "
            f"from (select cast({sql} as bigint) as n)")


def _nulls(table: str, column: str) -> str:
    return f"(select count(*) from {table} where {column} is null)"


def _dups(table: str, column: str) -> str:
    return (f"(select count(*) from (select {column} from {table} where {column} is not null "
            f"group by 1 having count(*) > 1))")


def _orphans(name: str, child: str, key: str, parent: str, parent_key: str) -> str:
    return _dq(name, "foreign_key", "pmid",
               f"(select count(*) from {child} where {key} is not null and {key} not in "
               f"(select {parent_key} from {parent}))")


def oracle() -> dict[str, str]:
    rules = _rules("rules", "abstracts")
    rule_columns = _plain("r_")
    extraction_columns = f"{_flat('f_')}"
    originals = _flat("o_", "original_")
    prompt = (f"{_text(PROMPT_HEAD)} || abstract_text || "
              f"{_text(PROMPT_TAIL)}")
    month = ("case month when 'Mar' then 3 when 'Dec' then 12 when '11' then 11 when '7' then 7 "
             "end")
    q: dict[str, str] = {}

    q["xml_articles"] = _with(ABSTRACTS, select=f"""
select pmid, title || ' in vivo' as title,
       'AIM: H2O' || {_pick(fx.ARTICLE_MARKUP_TEXT, 'cast(pmid as bigint) % 4')} || chr(10)
         || abstract_text as abstract_text,
       'Roe, R|' || journal as authors, journal,
       cast(cast(pmid as bigint) % 40 + 1985 as varchar) || '-03-01' as pub_date,
       {_joined('mesh_terms')} as mesh_terms from abstracts where cast(pmid as bigint) % 29 <> 0""")
    q["xml_rejects"] = """
select cast(doc_id as varchar) as pmid, true as bare_ampersand from documents where doc_id % 29 = 0"""
    q["pub_dates"] = f"""
with parts as (
  select doc_id, case when doc_id % 9 <> 0 then cast(doc_id % 40 + 1985 as varchar) end as year,
         {_pick(['Mar', '11', '7', 'Summer', None, 'Dec'], 'doc_id % 6')} as month,
         {_pick(['15', '5', None, '31', 'x'], 'doc_id % 5')} as day from documents),
dated as (
  select doc_id, case when year is null then null
         when month = 'Summer' or day = 'x' then year || '-01-01'
         else year || '-' || lpad(cast(coalesce({month}, 1) as varchar), 2, '0') || '-'
              || lpad(coalesce(day, '1'), 2, '0') end as pub_date from parts)
select cast(doc_id as varchar) as pmid, pub_date, try_cast(pub_date as date) as valid_date
from dated"""
    q["parse_raw"] = _with(ABSTRACTS, select=f"""
select pmid, '  <b>' || title || '</b> ' as title,
       '<p>' || abstract_text || ' &amp; more</p>' as abstract_text, authors, journal,
       case when cast(pmid as bigint) % 19 = 0 then '2023-02-30'
            else strftime(pub_date, '%Y-%m-%d') end as pub_date,
       {_joined('mesh_terms')} as mesh_terms from abstracts""")
    q["normalize_text"] = f"select page_id, {_collapse(_DECODED)} as clean_text from pages"
    q["clean_abstracts"] = _with(ABSTRACTS, select=_CLEANED)
    q["archive_readback"] = _with(ABSTRACTS, select="""
select pmid, date '2024-06-01' as archive_date, '  <b>' || title || '</b> ' as title,
       '<p>' || abstract_text || ' &amp; more</p>' as abstract_text, journal from abstracts""")

    q["rule_extract"] = _with(ABSTRACTS, rules, select=f"select pmid, {rule_columns} from rules")
    q["extraction_confidence"] = _with(PAIRS, select=f"""
select pmid, {_score('o_')} as original_score, {_score('f_')} as final_score from pairs""")
    q["extraction_rows"] = _with(ABSTRACTS, rules, select=f"""
select pmid, {rule_columns}, {_score('r_', True)} as confidence_score,
       'rules-v1' as model_version from rules""")
    q["prompts"] = _with(ABSTRACTS, select=f"select pmid, {prompt} as prompt from abstracts")
    chosen = ", ".join(f"case when ok then m_{f} else r_{f} end as {f}" for f in RECORD)
    q["model_output_parse"] = _with(ABSTRACTS, rules, _model_rows(), select=f"""
select pmid, {chosen} from rules join model_rows on kind = cast(pmid as bigint) % 16""")
    answered = "length(prompt) % 3 <> 1 and length(prompt) % 300 <> 0"
    inferred = ", ".join(
        f"case when {answered} then "
        + {"sample_size": "length(prompt)", "treatment_modality": "''", "biomarkers": "''"}.get(
            f, "null") + f" else r_{f} end as {f}"
        for f in RECORD
    )
    q["batch_inference"] = _with(
        ABSTRACTS, rules,
        f"asked as (select *, {prompt} as prompt from rules)",
        f"answers as (select pmid, {inferred}, case when {answered} then 'model' else 'rules' end "
        "as read_by from asked)",
        select=f"""select *, {_score('', True)} as confidence_score, 'stub' as model_version
from answers""")
    q["key_findings"] = _with(
        ABSTRACTS, select=f"select pmid, {KEY_FINDING} as key_finding from abstracts")
    q["notes"] = _with(ABSTRACTS, rules, select=f"""
select pmid, {_note('r_')} as summary_text, 'template-v1' as model_version from rules""")

    q["unprocessed"] = _with(ABSTRACTS, select="""
select pmid, title, length(abstract_text) as n_chars from abstracts
where pmid not in (select cast(doc_id as varchar) from labels)""")
    q["new_keys"] = """
select cast(doc_id as varchar) as pmid from documents
where doc_id not in (select doc_id from labels)"""
    q["needs_notes"] = _with(ABSTRACTS, EXTRACTIONS, select=f"""
select pmid, abstract_text, {extraction_columns}
from extractions join abstracts using (pmid)
where pmid not in (select cast(page_id as varchar) from pages)""")
    q["insert_if_absent"] = """
select cast(doc_id as varchar) as pmid, 'stored' as raw_json from labels
union all
select cast(conv_id as varchar), role || ': ' || text from (
  select * from conversations
  qualify row_number() over (partition by conv_id order by turn) = 1)
where conv_id not in (select doc_id from labels)"""
    flat_abstract = (f"pmid, title, abstract_text, authors, pub_date, "
                     f"{_joined('mesh_terms')} as mesh_terms, journal")
    q["replace_by_key"] = _with(ABSTRACTS, PAGE_ABSTRACTS, select=f"""
select {flat_abstract} from abstracts where pmid not in (select pmid from page_abstracts)
union all select {flat_abstract} from page_abstracts""")
    q["cascade_delete"] = _with(EXTRACTIONS, select=f"""
select pmid, {extraction_columns}, confidence_score, human_verified from extractions
where pmid not in (select cast(page_id as varchar) from pages)""")
    page_rules = _rules("page_rules", "page_abstracts")
    new_rec = {f: f"b.r_{f}" for f in RECORD}
    old_rec = {f: _joined(f"f_{f}") if f in LISTS else f"f_{f}" for f in RECORD}
    old_orig = {f: _joined(f"o_{f}") if f in LISTS else f"o_{f}" for f in RECORD}
    merged = ", ".join(
        f"case when b.pmid is null then {old_rec[f]} else {new_rec[f]} end as {f}"
        for f in RECORD)
    merged_orig = ", ".join(
        f"case when e.pmid is not null and (has_original or b.pmid is null) then {old_orig[f]} "
        f"else {new_rec[f]} end as original_{f}" for f in RECORD)
    q["upsert_extractions"] = _with(PAGE_ABSTRACTS, page_rules, EXTRACTIONS, select=f"""
select coalesce(e.pmid, b.pmid) as pmid, {merged}, {merged_orig},
       case when b.pmid is null then confidence_score else {_score('b.r_', True)} end
         as confidence_score,
       case when b.pmid is null then 'v0' else 'v1' end as model_version,
       case when e.pmid is null then false else human_verified end as human_verified,
       reviewer_notes
from extractions e full join page_rules b on e.pmid = b.pmid""")
    q["upsert_notes"] = _with(
        ABSTRACTS, EXTRACTIONS, NOTES,
        f"flat as (select pmid, abstract_text, {_flat('f_', 'x_')} "
        "from extractions join abstracts using (pmid))",
        f"fresh as (select pmid, {_note('x_')} as summary_text from flat)",
        select="""
select coalesce(n.pmid, f.pmid) as pmid, coalesce(f.summary_text, n.summary_text)
         as summary_text, case when f.pmid is null then 'v0' else 'v1' end as model_version
from notes n full join fresh f on n.pmid = f.pmid""")
    q["reset_outputs"] = """
select cast(0 as bigint) as rows_after,
       (select count(*) from labels) + (select count(*) from pages) as rows_before"""
    q["backfill_original"] = _with(EXTRACTIONS, select="select pmid, " + ", ".join(
        f"case when has_original then {old_orig[f]} else {old_rec[f]} end as original_{f}"
        for f in RECORD) + " from extractions")
    q["run_state"] = _with(ABSTRACTS, rules, select=f"""
select pmid, {rule_columns}, {_score('r_', True)} as confidence_score, false as human_verified,
       'template-v1' as note_version from rules""")
    q["stage_counts"] = """
with n as (select count(*) as n from documents)
select unnest(['ingested', 'archived', 'raw', 'cleaned', 'extracted', 'noted']) as stage, n
from n"""

    queue_ctes = (ABSTRACTS, EXTRACTIONS, NOTES, QUEUE)
    q["review_queue"] = _with(*queue_ctes, select="""
select * from queue
order by human_verified nulls last, confidence_score nulls last, pmid""")
    q["review_queue_filtered"] = _with(*queue_ctes, select="""
select * from queue where not coalesce(human_verified, false)
  and coalesce(confidence_score, 0) >= 0.4""")
    q["review_edits"] = """
select event_id, event_type as tnm_stage,
       event_type || '|x|' || cast(event_id as varchar) as treatment_modality,
       case when value > 20 then 'a|' || event_type else '' end as biomarkers,
       case when event_id % 3 = 0 then null
            when trunc(value) >= 0 then cast(trunc(value) as bigint) end as sample_size,
       case when user_id % 2 = 0 then null else 'Lung Cancer' end as cancer_type
from events"""
    edited = {
        "tnm_stage": "d.d_tnm_stage", "treatment_modality": "d.d_treatment_modality",
        "biomarkers": "d.d_biomarkers",
        "sample_size": "case when d.d_size >= 0 then d.d_size end",
        "cancer_type": "d.d_cancer_type",
    }
    q["apply_reviews"] = _with(EXTRACTIONS, DECISIONS, select="select x.pmid, " + ", ".join(
        f"case when d.pmid is null then {old_rec[f]} else {edited[f]} end as {f}"
        for f in RECORD) + f""", {originals},
       case when l.pmid is null then x.human_verified else l.action = 'approve' end
         as human_verified,
       case when l.pmid is null then x.reviewer_notes else l.notes end as reviewer_notes
from extractions x left join last_action l on x.pmid = l.pmid
     left join last_edit d on x.pmid = d.pmid""")
    q["dashboard_stats"] = _with(EXTRACTIONS, select="""
select count(*) as total, count(*) filter (human_verified) as verified,
       coalesce(cast(round(cast(avg(confidence_score) as decimal(20,10)), 2) as double), 0.0)
         as avg_confidence,
       (count(*) filter (human_verified))::double / nullif(count(*), 0) as verification_rate
from extractions""")
    q["confidence_bands"] = _with(EXTRACTIONS, select="""
select case when confidence_score >= 0.8 then 'High (0.8-1.0)'
            when confidence_score >= 0.4 then 'Medium (0.4-0.8)'
            else 'Low (0.0-0.4)' end as confidence_band, count(*) as n
from extractions group by 1 order by 1""")
    q["verified_pairs"] = _with(EXTRACTIONS, select=f"""
select pmid, {originals}, {_flat('f_', 'final_')} from extractions
where human_verified and has_original""")
    q["field_agreement"] = _with(PAIRS, select=f"select pmid, {MATCHED} from pairs")
    q["field_agreement_rates"] = _with(
        EXTRACTIONS,
        f"matched as (select {MATCHED} from extractions where human_verified and has_original)",
        select=" union all ".join(
            f"select '{f}' as field, count(*) filter ({f}_match) as agreed, count(*) as n, "
            f"(count(*) filter ({f}_match))::double / count(*) as agreement_rate from matched"
            for f in RECORD))
    differing = _with(
        PAIRS, f"matched as (select pmid, {MATCHED} from pairs)",
        f"differing as (select pmid, {DIFFERING} as fields from matched)",
        select="select pmid, fields from differing where fields <> ''")
    q["disagreements"] = differing
    q["disagreements_top5"] = differing + " order by pmid limit 5"
    q["record_json"] = _with(EXTRACTIONS, select=f"select pmid, {_flat('o_')} from extractions")

    q["validation_metrics_scalar"] = _with(PAIRS, GOLD, SCORED, select=" union all ".join(
        _text_metrics(f) for f in ("tnm_stage", "cancer_type")))
    q["validation_metrics_list"] = _with(PAIRS, GOLD, SCORED, select=" union all ".join(
        _list_metrics(f) for f in LISTS))
    q["validation_metrics_size"] = _with(PAIRS, GOLD, SCORED, select=_EVAL_SIZE)
    q["validation_run_log"] = _with(
        PAIRS, GOLD, SCORED,
        "prf as (" + " union all ".join(
            [_text_metrics(f) for f in ("tnm_stage", "cancer_type")]
            + [_list_metrics(f) for f in LISTS]) + ")",
        select=f"""select 'run-1' as run_id, 'v0' as model_version, field, tp,
       cast(null as bigint) as n, cast(null as bigint) as correct,
       (select count(*) from scored) as sample_size from prf
union all select 'run-1', 'v0', field, null, n, correct, (select count(*) from scored)
from ({_EVAL_SIZE})""")

    q["stg_abstracts"] = _with(ABSTRACTS, select=f"""
select pmid as abstract_id, pmid, title, pub_date as publication_date,
       extract(year from pub_date) as publication_year, {_joined('mesh_terms')} as mesh_terms,
       journal, length(abstract_text) as abstract_length
from abstracts where length(abstract_text) > 10""")
    q["abstract_flags"] = _with(ABSTRACTS, FLAGGED, select=f"""
select abstract_id, cancer_type, {', '.join(FLAGS)} from flagged""")

    def n(flag: str) -> str:
        return f"count(*) filter ({flag})"

    def pct(flag: str) -> str:
        return f"((2000 * {n(flag)} + count(*)) // (2 * count(*))) / 10.0::double"

    q["mart_cancer_studies"] = _with(ABSTRACTS, FLAGGED, select=f"""
select publication_year, cancer_type, journal, count(*) as study_count,
       avg(abstract_length) as avg_abstract_length, {n('mentions_ebv')} as ebv_studies,
       {n('mentions_pdl1')} as pdl1_studies, {n('mentions_p53')} as p53_studies,
       {n('mentions_chemotherapy')} as chemo_studies,
       {n('mentions_radiation')} as radiation_studies,
       {n('mentions_immunotherapy')} as immunotherapy_studies
from flagged where publication_year is not null group by 1, 2, 3
order by publication_year desc, study_count desc""")
    q["mart_treatment_outcomes"] = _with(ABSTRACTS, FLAGGED, select=f"""
select publication_year, cancer_type, count(*) as total_abstracts,
       {n('mentions_chemotherapy')} as chemo_count, {n('mentions_radiation')} as radiation_count,
       {n('mentions_immunotherapy')} as immunotherapy_count,
       {n('mentions_chemotherapy and mentions_radiation')} as chemoradiation_count,
       {pct('mentions_chemotherapy')} as chemo_pct, {pct('mentions_radiation')} as radiation_pct,
       {pct('mentions_immunotherapy')} as immunotherapy_pct,
       {n('mentions_ebv')} as ebv_mentions, {n('mentions_pdl1')} as pdl1_mentions
from flagged where publication_year is not null group by 1, 2
order by publication_year desc, total_abstracts desc""")
    both_marts = f"""
select 'mart_cancer_studies' as model, publication_year, cancer_type, journal, count(*) as n,
       {n('mentions_chemotherapy')} as chemo
from flagged where publication_year is not null group by all
union all
select 'mart_treatment_outcomes', publication_year, cancer_type, null, count(*),
       {n('mentions_chemotherapy')}
from flagged where publication_year is not null group by all"""
    q["built_models"] = _with(ABSTRACTS, FLAGGED, select=both_marts)
    q["dq_report"] = _with(ABSTRACTS, EXTRACTIONS, FLAGGED, select=" union all ".join([
        _dq("cleaned", "not_null", "pmid", _nulls("abstracts", "pmid")),
        _dq("cleaned", "not_null", "pub_date", _nulls("abstracts", "pub_date")),
        _dq("cleaned", "unique", "pmid", _dups("abstracts", "pmid")),
        _dq("extractions", "not_null", "pmid", _nulls("extractions", "pmid")),
        _dq("extractions", "not_null", "confidence_score",
            _nulls("extractions", "confidence_score")),
        _dq("extractions", "unique", "pmid", _dups("extractions", "pmid")),
        _dq("stg_abstracts", "not_null", "abstract_id", _nulls("flagged", "abstract_id")),
        _dq("stg_abstracts", "not_null", "pmid", _nulls("flagged", "abstract_id")),
        _dq("stg_abstracts", "not_null", "abstract_text", _nulls("abstracts", "abstract_text")),
        _dq("stg_abstracts", "unique", "abstract_id", _dups("flagged", "abstract_id")),
        _dq("int_abstracts_parsed", "not_null", "abstract_id", _nulls("flagged", "abstract_id")),
        _dq("int_abstracts_parsed", "unique", "abstract_id", _dups("flagged", "abstract_id")),
        _dq("int_abstracts_parsed", "accepted_values", "cancer_type",
            "(select count(*) from flagged where cancer_type not in ("
            "'Nasopharyngeal Carcinoma', 'Lung Cancer', 'Breast Cancer', 'Other/Unspecified'))"),
        *[_dq(m, "not_null", c, "0") for m in ("mart_cancer_studies", "mart_treatment_outcomes")
          for c in ("publication_year", "cancer_type")],
        _dq("conversations", "not_null", "conv_id", _nulls("conversations", "conv_id")),
        _dq("conversations", "not_null", "text", _nulls("conversations", "text")),
        _dq("conversations", "accepted_values", "role",
            "(select count(*) from conversations where role not in ('user', 'assistant'))"),
        _dq("conversations", "unique", "conv_id", _dups("conversations", "conv_id")),
    ]))
    q["dq_foreign_keys"] = " union all ".join([
        _orphans("extractions", "labels", "doc_id", "documents", "doc_id"),
        _orphans("notes", "pages", "page_id", "documents", "doc_id"),
        _orphans("notes_without_extraction", "pages", "page_id", "labels", "doc_id"),
        _orphans("turns_without_extraction", "conversations", "conv_id", "labels", "doc_id"),
    ])

    # The same results by other means.
    for name, like in (
        ("bucketed_replace", "replace_by_key"), ("bucketed_delete", "cascade_delete"),
        ("bucketed_insert", "insert_if_absent"), ("bucketed_upsert_extractions", "upsert_extractions"),
        ("bucketed_upsert_notes", "upsert_notes"), ("inference_distinct", "batch_inference"),
        ("state_of_runs", "run_state"), ("review_stream", "apply_reviews"), ("dq_observed", "dq_report"),
    ):
        q[name] = q[like]
    q["review_queue_page"] = q["review_queue"] + " limit 50 offset 50"
    q["lexicon_many"] = """
with terms as (
  select distinct unnest(regexp_extract_all(lower(text), '[a-z]{4,}')) as term from benchmark),
found as (
  select doc_id, count(*) as n_terms, string_agg(term, '|' order by term) as terms
  from documents join terms on contains(lower(text), term) group by doc_id)
select doc_id, coalesce(n_terms, 0) as n_terms, coalesce(terms, '') as terms
from documents left join found using (doc_id)"""
    q["lexicon_labels"] = _with(
        ABSTRACTS, rules, select="select pmid, r_treatment_modality as treatment_modality, "
        "r_biomarkers as biomarkers from rules")
    q["candidate_cap"] = _with(ABSTRACTS, select="""
select pmid, title, pub_date from abstracts order by pub_date desc nulls last, pmid limit 100""")
    q["key_range_rows"] = _with(ABSTRACTS, select="select pmid, true as in_order from abstracts")
    changed = """abstracts as (
  select * from (
    select * from old_abstracts where pmid not in (select pmid from page_abstracts)
    union all select * from page_abstracts
  ) where pmid not in (select cast(doc_id as varchar) from labels))"""
    before = ABSTRACTS.replace("abstracts as (", "old_abstracts as (", 1)
    q["marts_after_change"] = _with(before, PAGE_ABSTRACTS, changed, FLAGGED, select=both_marts)
    return q
