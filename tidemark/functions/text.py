"""Text, markup and small-JSON helpers as native Column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.fixed_values import CORPORATE_SUFFIXES, CP1252_BYTES, CP1252_CHARS
from tidemark.functions.once import let

_SUFFIX = r"\s+(?:" + "|".join(CORPORATE_SUFFIXES) + r")\s*$"


def first_rule(text: Column, rules: Sequence[tuple[str, str]], default) -> Column:
    """Label of the first rule whose keyword occurs in the lower-cased text."""
    lowered = F.lower(text)
    chain = F.when(F.lit(False), F.lit(None).cast("string"))
    for keyword, label in rules:
        chain = chain.when(F.contains(lowered, F.lit(keyword)), label)
    return chain.otherwise(default)


def categorise(key: Column, text: Column, rules, overrides: Mapping[str, str], default: str) -> Column:
    """Ordered keyword categoriser; a key listed in ``overrides`` wins over every keyword."""
    return F.coalesce(relabel(key, overrides, passthrough=False), first_rule(text, rules, default))


def breadcrumb_category(breadcrumb: Column, rules, fallback: Column) -> Column:
    """Label of the second breadcrumb segment (or the only one); unmatched segments are kept as they are."""
    parts = F.split(breadcrumb, ">")
    segment = F.trim(F.coalesce(F.get(parts, F.lit(1)), F.get(parts, F.lit(0))))
    return F.when(F.coalesce(breadcrumb, F.lit("")) == "", fallback).otherwise(first_rule(segment, rules, segment))


def relabel(code: Column, labels: Mapping[str, str], passthrough: bool = True) -> Column:
    """Code to label by a literal map; unknown codes pass through or become NULL."""
    if not labels:
        return code if passthrough else F.lit(None).cast("string")
    table = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    found = F.try_element_at(table, code)
    return F.coalesce(found, code) if passthrough else found


def two_level_path(path: Column) -> Column:
    """At most the first two ``>`` levels, trimmed; a path without ``>`` is kept as it is."""
    parts = F.transform(F.split(path, ">"), lambda p: F.trim(p))
    return F.when(F.size(parts) >= 2, F.array_join(F.slice(parts, 1, 2), ">")).otherwise(path)


def deepest_label(labels: Column, default: str = "Other") -> Column:
    """Last non-empty label of a shallow-to-deep array."""
    named = F.filter(labels, lambda x: x.isNotNull() & (x != ""))
    return F.coalesce(F.try_element_at(named, F.lit(-1)), F.lit(default))


def base_key(key: Column, cut: str = "first") -> Column:
    """Part of the key before its ``first`` or ``last`` dash."""
    if cut == "first":
        return F.substring_index(key, "-", 1)
    return F.regexp_replace(key, r"-[^-]*$", "")


def canonical(text: Column) -> Column:
    """Lower case, punctuation to blanks, blanks squeezed; NULL counts as empty."""
    blanked = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"(?U)[\s\-()\[\],.:/®™]+", " ")
    return F.trim(blanked)


def slug(text: Column) -> Column:
    """URL slug: runs of anything but a-z and 0-9 become one dash."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")


def unslug(text: Column) -> Column:
    """Dashes to blanks; every letter that follows a non-letter is capitalised."""
    pieces = F.split(F.replace(text, F.lit("-"), F.lit(" ")), r"(?<=[^A-Za-z])(?=[A-Za-z])")
    titled = F.transform(pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lower(F.substr(p, F.lit(2)))))
    return F.array_join(titled, "")


def link_values(html: Column, parameter_pattern: str) -> Column:
    """Distinct decoded values that follow ``parameter_pattern``, up to a quote, ``&`` or blank."""
    raw = F.regexp_extract_all(html, F.lit(parameter_pattern + r'([^"&\s]+)'), F.lit(1))
    return F.array_distinct(F.transform(raw, lambda v: F.coalesce(F.try_url_decode(v), F.translate(v, "+", " "))))


def path_slugs(html: Column, folder_pattern: str) -> Column:
    """Distinct slugs under a folder, with ``.html`` or followed by a quote or blank."""
    name = folder_pattern + r"([A-Za-z0-9][A-Za-z0-9-]+)"
    with_ending = F.regexp_extract_all(html, F.lit(name + r"\.html"), F.lit(1))
    bare = F.regexp_extract_all(html, F.lit(name + r'(?=["\s])'), F.lit(1))
    return F.array_union(with_ending, bare)


def pick_language(texts: Column, preferred: Sequence[str] = ("eng", "swe")) -> Column:
    """Text of the first preferred language present, else of the first one; lists are comma-joined."""
    choices = [F.try_element_at(texts, F.lit(lang)) for lang in preferred]
    chosen = F.coalesce(*choices, F.get(F.map_values(texts), F.lit(0)))
    return F.coalesce(F.array_join(chosen, ", "), F.lit(""))


def member(document: Column, name: str) -> Column:
    """Member of a VARIANT document by its own name, dashes included."""
    return F.try_variant_get(document, f"$['{name}']", "variant")


def any_text(value: Column, first: Column | None = None, preferred: Sequence[str] = ("eng", "swe")) -> Column:
    """Text of a VARIANT that may be text, number, list or {language: text or list}; empty when there is none.

    Of several languages the first preferred one counts, else ``first``. Lists are comma-joined, their nulls skipped;
    numbers and booleans come in JSON's shortest form.
    """
    def listed(v: Column) -> Column:
        return F.array_join(F.transform(F.try_variant_get(v, "$", "array<variant>"), plain), ", ")

    def plain(v: Column) -> Column:
        return F.try_variant_get(v, "$", "string")

    def one(v: Column) -> Column:
        return F.coalesce(listed(v), plain(v))

    def chosen(languages: Column) -> Column:
        choices = [one(F.try_element_at(languages, F.lit(lang))) for lang in preferred]
        other = F.get(F.map_values(languages), F.lit(0)) if first is None else F.try_element_at(languages, first)
        return F.when(languages.isNotNull(), F.coalesce(*choices, one(other), F.lit("")))

    spoken = let(F.try_variant_get(value, "$", "map<string,variant>"), chosen)
    return F.coalesce(listed(value), spoken, plain(value), F.lit(""))


def member_texts(document: Column, json_text: Column, names: Sequence[str], preferred: Sequence[str] = ("eng", "swe")) -> Column:
    """{name: text} of the listed members of a VARIANT document, by ``any_text``.

    A VARIANT keeps no order of members, so where no preferred language is given the first one is looked up in the text.
    """
    listed = F.array(*[F.lit(n) for n in names])

    def first(name: Column) -> Column:
        path = F.concat(F.lit("$['"), name, F.lit("']"))
        return F.get(F.json_object_keys(F.call_function("get_json_object", json_text, path)), F.lit(0))

    def text(members: Column, name: Column) -> Column:
        return let(F.try_element_at(members, name), lambda v: any_text(v, first(name), preferred))

    members = F.try_variant_get(document, "$", "map<string,variant>")
    return let(members, lambda m: F.map_from_arrays(listed, F.transform(listed, lambda name: text(m, name))))


def any_texts(value: Column) -> Column:
    """Items of a VARIANT list as texts, or its one scalar; an empty array when it is missing."""
    items = F.transform(F.try_variant_get(value, "$", "array<variant>"), lambda v: F.try_variant_get(v, "$", "string"))
    alone = F.try_variant_get(value, "$", "string")
    return F.coalesce(items, F.when(alone.isNotNull(), F.array(alone)), F.array().cast("array<string>"))


def is_given(value: Column) -> Column:
    """False for a VARIANT that is missing, null, false, zero, an empty text, an empty list or an empty object."""
    def filled(text: Column) -> Column:
        plain = ~text.isin("[]", "{}", "false") & (F.coalesce(text.try_cast("double"), F.lit(1.0)) != 0)
        return text.isNotNull() & F.when(F.schema_of_variant(value) == "STRING", text != "").otherwise(plain)

    return let(F.try_variant_get(value, "$", "string"), filled)


def pick_link(links: Column, preferred: Sequence[str] = ("ENG", "SWE")) -> Column:
    """Link of the first preferred language present, else the first link, else empty."""
    choices = [F.try_element_at(links, F.lit(lang)) for lang in preferred]
    return F.coalesce(*choices, F.get(F.map_values(links), F.lit(0)), F.lit(""))


def pick_name(names: Column, preferred: Sequence[str], default: Column) -> Column:
    """First non-empty preferred name, else the first one, else the default."""
    choices = [F.nullif(F.try_element_at(names, F.lit(lang)), F.lit("")) for lang in preferred]
    return F.coalesce(*choices, F.get(F.map_values(names), F.lit(0)), default)


def org_number(text: Column) -> Column:
    """Organisation number reduced to letters and digits."""
    return F.regexp_replace(text, r"[^0-9A-Za-z]", "")


def strip_suffix(name: Column) -> Column:
    """Lower-cased name without a trailing corporate form."""
    return F.trim(F.regexp_replace(F.lower(name), _SUFFIX, ""))


def names_company(text: Column, company: Column) -> Column:
    """True when the text holds the company's name, with or without its corporate form."""
    lowered, full, core = F.lower(text), F.lower(company), strip_suffix(company)
    return F.contains(lowered, full) | ((core != full) & F.contains(lowered, core))


def may_name_company(markup: Column, company: Column) -> Column:
    """False only for markup in which no text can name the company: a cheap test before parsing.

    Text written with character references, comments or CDATA sections is always let through. The name without its
    corporate form is sought in any case by one pattern; lowering whole documents first costs several times the parse.
    """
    # The one letter whose lower case holds a plain letter that no pattern finds in it.
    special = [F.contains(markup, F.lit(mark)) for mark in ("&#", "<!--", "<![CDATA[", "\u0130")]
    core = F.regexp_replace(strip_suffix(company), r"([^\p{L}\p{N}\s])", r"\\$1")
    literal = F.rlike(markup, F.concat(F.lit("(?iu)"), core))
    return special[0] | special[1] | special[2] | special[3] | literal | company.rlike("[&<>\"']")


def relaxed_map(text: Column) -> Column:
    """Single-quoted mapping text to a map; NULL text or bad text gives an empty map."""
    parsed = F.from_json(text, "map<string,string>", {"allowSingleQuotes": "true"})
    return F.coalesce(parsed, F.from_json(F.lit("{}"), "map<string,string>"))


def json_attribute(text: Column, name: str) -> Column:
    """Attribute of a JSON string; NULL for bad JSON."""
    return F.get_json_object(text, "$." + name)


def has_badge(badges: Column, theme: str) -> Column:
    """True when any badge of an array of structs carries the theme, in any case."""
    return F.coalesce(F.exists(badges, lambda b: F.upper(b["theme"]) == theme.upper()), F.lit(False))


def ld_product_price(html: Column, home_per_euro: Column) -> Column:
    """Price of the first priced Product block in a page's linked data; euro prices are converted."""
    blocks = F.regexp_extract_all(
        html, F.lit(r'(?is)<script[^>]+type=["\']application/ld\+json["\'][^>]*>(.*?)</script>'), F.lit(1)
    )

    def priced(block):
        def offer(name):
            listed = F.get_json_object(block, "$.offers[0]." + name)
            return F.coalesce(F.get_json_object(block, "$.offers." + name), listed)

        value = offer("price").try_cast("double")
        return F.when(offer("priceCurrency") == "EUR", F.bround(value * home_per_euro, 2)).otherwise(value)

    products = F.filter(blocks, lambda b: F.get_json_object(b, "$['@type']") == "Product")
    return F.get(F.filter(F.transform(products, priced), lambda p: p.isNotNull()), F.lit(0))


def table_column(html: Column, header_word: str) -> Column:
    """Cell texts of the first column whose header holds the word, over all tables of a stored page."""
    tag = r"(?s)<[^>]*>"
    tables = F.regexp_extract_all(html, F.lit(r"(?is)<table\b[^>]*>(.*?)</table>"), F.lit(1))

    def cells(table):
        heads = F.transform(
            F.regexp_extract_all(table, F.lit(r"(?is)<th\b[^>]*>(.*?)</th>"), F.lit(1)),
            lambda h: F.contains(F.lower(F.regexp_replace(h, tag, "")), F.lit(header_word)),
        )
        at = F.array_position(heads, True).cast("int")
        rows = F.regexp_extract_all(table, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1))
        texts = F.transform(
            rows,
            lambda row: F.get(F.regexp_extract_all(row, F.lit(r"(?is)<td\b[^>]*>(.*?)</td>"), F.lit(1)), at - 1),
        )
        plain = F.transform(texts, lambda t: F.trim(F.regexp_replace(t, tag, "")))
        return F.when(at > 0, F.filter(plain, lambda t: t.isNotNull())).otherwise(F.array().cast("array<string>"))

    return F.flatten(F.transform(tables, cells))


def clip(text: Column, width: int = 500) -> Column:
    """First ``width`` characters."""
    return F.substring(text, 1, width)


def looks_garbled(text: Column) -> Column:
    """True for text that shows the usual trace of UTF-8 read as Latin-1."""
    return F.contains(text, F.lit("Ã"))


def repair_garbled(text: Column) -> Column:
    """Undo a UTF-8 -> Latin-1/Windows-1252 misreading; text that would not decode is kept as it is."""
    as_latin = F.translate(text, CP1252_CHARS, "".join(chr(b) for b in CP1252_BYTES))
    fits = ~as_latin.rlike(r"[^\x00-\xFF]")
    # Only text that fits is used; the mask keeps the encoder from failing on the rest.
    raw = F.encode(F.regexp_replace(as_latin, r"[^\x00-\xFF]", "?"), "ISO-8859-1").cast("string")
    good = fits & F.is_valid_utf8(raw)
    return F.when(good, raw).otherwise(text)
