"""Text columns: cleaning, keys, number and date parsing, label/value fields. All are Column expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Letters with accents and what they become.
ACCENTED = "áàâãäåéèêëíìîïóòôõöúùûüçñýÿÁÀÂÃÄÅÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑÝ"
PLAIN = "aaaaaaeeeeiiiiooooouuuucnyyAAAAAAEEEEIIIIOOOOOUUUUCNY"
#: The references that pages hold most, and the one that must come last.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]
MOJIBAKE = "Ã|Â|ð|�"


def text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def strip_html(c: Column) -> Column:
    """O9 for the JVM: common references decoded, tags dropped, broken UTF-8 mended, white space collapsed; null is ''."""
    c = text(c)
    for name, value in ENTITIES:
        c = F.replace(c, F.lit(name), F.lit(value))
    return collapse(fix_mojibake(F.regexp_replace(c, "<[^>]+>", " ")))


@F.pandas_udf(T.StringType())
def _unescape_nfkc(values: pd.Series) -> pd.Series:
    import html
    import unicodedata

    return values.map(lambda v: unicodedata.normalize("NFKC", html.unescape(v)))


def strip_html_full(c: Column) -> Column:
    """O9 with every character reference and NFKC, through Arrow batches."""
    return collapse(F.regexp_replace(_unescape_nfkc(fix_mojibake(text(c))), "<[^>]+>", " "))


def fix_mojibake(c: Column) -> Column:
    """Text that shows signs of UTF-8 read as Latin-1 is encoded back, if it can be."""
    mended = F.decode(F.encode(c, "ISO-8859-1"), "UTF-8")
    return F.when(c.rlike(MOJIBAKE) & c.rlike(r"^[\x{0}-\x{FF}]*$"), mended).otherwise(c)


def unaccent(c: Column) -> Column:
    return F.translate(c, ACCENTED, PLAIN)


def normalize_key(c: Column) -> Column:
    """O11."""
    return F.btrim(collapse(unaccent(F.lower(text(c)))), F.lit(" :;-_"))


def slug(c: Column) -> Column:
    """O12."""
    return F.btrim(F.regexp_replace(unaccent(F.lower(text(c))), "[^a-z0-9]+", "_"), F.lit("_"))


def norm_text(c: Column) -> Column:
    return collapse(unaccent(F.upper(text(c))))


def norm_town(c: Column) -> Column:
    """Without a leading code and 'MUNICIPIO DE '."""
    return F.replace(F.regexp_replace(norm_text(c), r"^\d+\s*[-.]?\s*", ""), F.lit("MUNICIPIO DE "), F.lit(""))


#: Spellings that differ between sources.
SPELLINGS = [("SANTO ANTONIO DO LEVERGER", "SANTO ANTONIO DE LEVERGER"), ("POXOREU", "POXOREO"), ("VILA BELA SANTISSIMA TRINDADE", "VILA BELA DA SANTISSIMA TRINDADE")]


def join_town(c: Column, spellings=SPELLINGS) -> Column:
    c = norm_town(c)
    for a, b in spellings:
        c = F.replace(c, F.lit(a), F.lit(b))
    return F.regexp_replace(c, "[^A-Z0-9]", "")


def decimal_br(c: Column, coordinates: bool = False) -> Column:
    """O14: '1.234,56' to a double. ``coordinates``: numbers over 1000 are scaled ones."""
    v = F.replace(F.replace(F.trim(text(c)), F.lit("."), F.lit("")), F.lit(","), F.lit(".")).try_cast("double")
    return F.when(F.abs(v) > 1000, v / 10000.0).otherwise(v) if coordinates else v


def proportion(v: Column) -> Column:
    return F.when(v > 100, v / 100.0).otherwise(v)


def index_01(v: Column) -> Column:
    return F.when(v > 100, v / 1000.0).when(v > 1, v / 100.0).otherwise(v)


def normalize_prop(v: Column) -> Column:
    return F.when(v > 1.5, v / 100.0).otherwise(v)


def date_of(c: Column) -> Column:
    """O15 by row: compact, ISO, then day first; years outside 1990 to 2100 are null."""
    c = F.trim(text(c))
    d = F.coalesce(
        F.when(c.rlike(r"^\d{8}$"), F.try_to_timestamp(c, F.lit("yyyyMMdd"))),
        F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(F.substring(c, 1, 10), F.lit("yyyy-MM-dd"))),
        F.when(c.rlike(r"^\d{2}/\d{2}/\d{4}"), F.try_to_timestamp(F.substring(c, 1, 10), F.lit("dd/MM/yyyy"))),
    ).cast("date")
    return F.when(F.year(d).between(1990, 2100), d)


def first_filled(*columns: Column) -> Column:
    """The first that is neither null nor blank."""
    return F.coalesce(*[F.when(F.trim(text(c)) != "", F.trim(text(c))) for c in columns])


FIELD = r"(?s)^([^:]{1,120}):\s*(.*)$"


def field_label(raw: Column) -> Column:
    """What stands before the colon, or all of a field without one."""
    raw = collapse(text(raw))
    return F.when(raw.rlike(FIELD), F.trim(F.regexp_extract(raw, FIELD, 1))).otherwise(raw)


def field_value(raw: Column) -> Column:
    raw = collapse(text(raw))
    return F.when(raw.rlike(FIELD), F.trim(F.regexp_extract(raw, FIELD, 2))).otherwise("")


def has_real_value(raw: Column) -> Column:
    """O20."""
    return ~normalize_key(field_value(raw)).isin("", "-", "na", "n/a")


def schema_signature(raws: list[Column]) -> Column:
    keys = [normalize_key(field_label(r)) for r in raws]
    return F.concat_ws(" | ", *[F.when(k == "", "vazio").otherwise(k) for k in keys])


def record_id(ids: list[Column], fallback: list[Column]) -> Column:
    """O26."""
    filled = F.concat_ws("|", *[F.nullif(F.trim(text(c)), F.lit("")) for c in ids])
    return F.when(filled != "", filled).otherwise(F.concat_ws("|", F.lit("anon"), *[F.trim(text(c)) for c in fallback]))


#: Known states of an exam.
STATUS = {"exame liberado": "liberado", "aguardando triagem": "aguardando_triagem", "aguardando processamento": "aguardando_processamento", "em analise": "em_analise", "cancelado": "cancelado", "exame nao realizado": "nao_realizado"}


def exam_status(c: Column) -> Column:
    """O25."""
    key = normalize_key(c)
    known = F.element_at(F.create_map(*[F.lit(x) for kv in STATUS.items() for x in kv]), key)
    return F.when(key == "", "status_ausente").otherwise(F.coalesce(known, slug(key)))


def network_status(c: Column) -> Column:
    """O25, the coarse form: which word the state holds."""
    key = normalize_key(c)
    return F.when(key.contains("rejeit") | key.contains("cancel"), "rejeitado").when(key.contains("aguard") | key.contains("pend") | key.contains("process"), "pendente").when(key.contains("liber"), "liberado").when(key.contains("inconcl"), "inconclusivo").otherwise("outro")


def sex(c: Column) -> Column:
    c = norm_text(c)
    return F.when(c.startswith("F"), "FEMININO").when(c.startswith("M"), "MASCULINO").otherwise("IGNORADO")


def race(c: Column) -> Column:
    c, out = norm_text(c), F.lit("IGNORADO")
    for k in ["INDIGENA", "AMARELA", "PARDA", "PRETA", "BRANCA"]:
        out = F.when(c.contains(k), k).otherwise(out)
    return out


def schooling(c: Column) -> Column:
    return F.coalesce(F.nullif(norm_text(c), F.lit("")), F.lit("IGNORADO"))


#: Upper ends of the age groups.
AGE_GROUPS = [(4, "1-4"), (9, "5-9"), (14, "10-14"), (19, "15-19"), (29, "20-29"), (39, "30-39"), (49, "40-49"), (59, "50-59"), (69, "60-69"), (79, "70-79")]


def age_group(age: Column) -> Column:
    """O32."""
    out = F.when(age.isNull(), "IGNORADO").when(age < 1, "<1")
    for top, name in AGE_GROUPS:
        out = out.when(age <= top, name)
    return out.otherwise("80+")


def age_at(event: Column, birth: Column) -> Column:
    return F.round(F.datediff(event, birth) / 365.25, 1)
