"""Column expressions of the data model: ids, weights, texts, display."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schema as S

#: Cyrillic letters and what they become in a slug.
CYRILLIC = "абвгдеёзийклмнопрстуфхцыэ"
LATIN = "abvgdeeziiklmnoprstufhcye"
CYRILLIC_MORE = {"ж": "zh", "ч": "ch", "ш": "sh", "щ": "shch", "ю": "iu", "я": "ia", "ъ": "", "ь": "'"}
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyy"
ACCENTED_MORE = {"ß": "ss", "æ": "ae", "œ": "oe", "ø": "o"}
MARK = "[added_by=LLM] "
MAX_TEXT = 500


def blank(text: Column) -> Column:
    """Null, empty or white space alone."""
    return text.isNull() | ~text.rlike(r"(?U)\S")


def slug(filename: Column) -> Column:
    """A file name's stem in Latin letters and lower case, with _ for spaces and dots."""
    base = F.regexp_extract(filename, r"([^/]*)$", 1)
    stem = F.regexp_replace(base, r"(?<=.)\.[^.]*$", "")
    out = F.translate(F.translate(F.lower(stem), CYRILLIC, LATIN), ACCENTED, PLAIN)
    for a, b in (CYRILLIC_MORE | ACCENTED_MORE).items():
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.translate(out, " .", "__")


def strip_scripts(text: Column) -> Column:
    """The text without its script and style elements."""
    low = F.lower(text)
    found = F.contains(low, F.lit("<script")) | F.contains(low, F.lit("<style"))
    return F.when(found, F.regexp_replace(text, r"(?is)<(script|style)\b.*?</\1\s*>", "")).otherwise(text)


def position(node_id: Column) -> Column:
    """The token position in an id of a Chunk or Assessment (slug:c:17, slug:q:17:1); null for other ids."""
    number = F.split_part(node_id, F.lit(":"), F.lit(3)).try_cast("int")
    return F.when(F.split_part(node_id, F.lit(":"), F.lit(2)).isin("c", "q"), number)


def position_or_fail(node_id: Column) -> Column:
    at = position(node_id)
    return F.when(at.isNotNull(), at).otherwise(F.raise_error(F.concat(F.lit("no position in id "), node_id)).cast("int"))


def inverse_weight(weight: Column) -> Column:
    w = F.coalesce(weight, F.lit(S.WEIGHT_METRICS))
    return F.when(w > 0, F.lit(1.0) / w).otherwise(F.lit(float("inf")))


def sanitised(weight: Column, least: float = 1e-9) -> Column:
    return F.when(weight > 0, weight).otherwise(F.lit(least))


def safe_metric(x: Column) -> Column:
    bad = x.isNull() | F.isnan(x) | x.isin(float("inf"), float("-inf"))
    return F.when(bad, F.lit(0.0)).otherwise(x)


def marked_definition(kind: Column, definition: Column) -> Column:
    """Definitions of Chunks and Assessments with MARK before them, once."""
    todo = kind.isin("Chunk", "Assessment") & ~blank(definition) & ~definition.startswith(MARK.strip())
    return F.when(todo, F.concat(F.lit(MARK), definition)).otherwise(definition)


def marked_conditions(conditions: Column) -> Column:
    done = F.contains(conditions, F.lit("added_by=")) | F.contains(conditions, F.lit("fixed_by=")) | F.contains(conditions, F.lit("auto_generated"))
    return F.when(~blank(conditions) & ~done, F.concat(F.lit(MARK), conditions)).otherwise(conditions)


def term_text(primary: Column, aliases: Column) -> Column:
    """primary (alias, alias), or primary alone."""
    return F.when(F.size(F.coalesce(aliases, F.array().cast("array<string>"))) > 0, F.concat(primary, F.lit(" ("), F.array_join(aliases, ", "), F.lit(")"))).otherwise(primary)


def tier(edge_type: Column) -> Column:
    return F.when(edge_type.isin(*S.STRONG), "strong").when(edge_type.isin(*S.WEAK), "weak").otherwise("medium")


def shortened(text: Column, most: int = MAX_TEXT, tail: str = "...") -> Column:
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit(tail))).otherwise(text)


def node_size(pagerank: Column, least: float = 20.0, most: float = 60.0) -> Column:
    return least + (most - least) * F.least(F.lit(1.0), F.ln(1000 * pagerank + 1) / F.ln(F.lit(1000.0)))


def opacity(difficulty: Column, least: float = 0.5, most: float = 1.0) -> Column:
    return least + (most - least) * (difficulty - 1) / 4


def whole_word(text: Column, term: Column) -> Column:
    """Whether the term stands in the text between word boundaries, in any case."""
    return F.rlike(F.lower(text), F.concat(F.lit(r"(?U)\b\Q"), F.lower(term), F.lit(r"\E\b")))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x)


def length_ratio(a: Column, b: Column) -> Column:
    return F.try_divide(F.least(F.length(a), F.length(b)), F.greatest(F.length(a), F.length(b)))


def cleaned_json(response: Column) -> Column:
    """A model's answer without a code fence around it and with href=x style attributes quoted for JSON."""
    out = F.regexp_replace(F.trim(response), r"(?s)^```(?:json)?\s*(.*?)\s*```$", "$1")
    return F.regexp_replace(out, r"""(?<=\s)(href|src|class|id|target)="([^"\\]*)\"""", r"""$1='$2'""")
