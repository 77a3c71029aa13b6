"""Invoice XML -> contract documents, as column expressions over all files at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from invoicelake import contract
from invoicelake.functions.text import (
    basename, blank_to_null, is_integer, literal, number_text, read_float, read_int, remove_first,
    strip, utc_seconds,
)
from invoicelake.operators.barrier import evaluate_once
from invoicelake.operators.xml_canonical import PLAIN, rewritten

# Reasons a document goes to quarantine.
UNSUPPORTED_ENCODING = "unsupported_encoding"
INVALID_ENCODING = "invalid_encoding"
MALFORMED_XML = "malformed_xml"
INVALID_ITEM_NUMBER = "invalid_item_number"

_DECLARATION = r"^\x{FEFF}?<\?xml\s[^>]*\?>"
_MAY_DECLARE = "startswith(text, '<?xml') OR startswith(text, '\\uFEFF')"
_DECLARED_ENCODING = r"^(?:\xEF\xBB\xBF)?<\?xml\s[^>]*?\sencoding\s*=\s*[\x22']([\w.-]+)[\x22']"

_UTF8_NAMES = ("", "utf-8", "utf8")
_ASCII_NAMES = ("us-ascii", "ascii")
_LATIN1_NAMES = ("iso-8859-1", "iso8859-1", "latin1", "latin-1")
_WINDOWS_NAMES = ("windows-1252", "cp1252")
# Windows-1252 is Latin-1 but for these code points, which Latin-1 gives to control characters.
_WINDOWS_CODES = [i for i in range(0x80, 0xA0) if bytes([i]).decode("cp1252", "ignore")]
_WINDOWS_FROM = "".join(map(chr, _WINDOWS_CODES))
_WINDOWS_TO = bytes(_WINDOWS_CODES).decode("cp1252")
# UTF-16 is told by its byte order mark, never by a declaration (those are read in lower case).
# Spark's decoder fails the job on half a surrogate pair, so the bytes, as hex digits, are
# searched for one first.
_UTF16 = "UTF-16"
_BYTE_ORDER_MARKS = ("FEFF", "FFFE")
_HALF_PAIRS = (
    "^(?:.{4})*?(?:D[89AB]..(?!D[C-F])|(?<!D[89AB]..)D[C-F])",
    "^(?:.{4})*?(?:..D[89AB](?!..D[C-F])|(?<!..D[89AB])..D[C-F])",
)

# The text is parsed as the content of this element, which shows what stands beside the root.
# Its name is one that no text holds by chance.
_WRAPPER = "invoice-file-5d1c0f7be2a94c38"
_PLAIN = f"coalesce({PLAIN} AND NOT contains(body, '{_WRAPPER}'), false)"


def parse_invoices(
    files: DataFrame,
    now: str = "current_timestamp()",
    sections: tuple[str, ...] | None = None,
) -> DataFrame:
    """(path, content) -> (path, source_file, error, document).

    `error` is null and `document` filled for a readable file; otherwise `error` names the
    reason and `document` is null. `now` is the ingestion time, a SQL expression. `sections`
    limits the documents to what the caller reads; the files are checked in full all the same.
    """
    nodes = contract.xml_schema(sections)
    texts = files.selectExpr("path", "content", f"{_DECLARED} AS encoding").selectExpr(
        "path", "encoding", f"{_DECODED} AS text"
    )
    checked = evaluate_once(texts, "path", "encoding", text="text").selectExpr(
        "path", "encoding", f"if({_MAY_DECLARE}, regexp_replace(text, {literal(_DECLARATION)}, ''), text) AS body"
    )
    checked = evaluate_once(checked, "path", "encoding", "body", plain=_PLAIN)
    usual = checked.select(
        "path", "encoding", F.col("body").isNull().alias("undecoded"),
        F.when(F.col("plain"), F.col("body")).otherwise(
            rewritten(F.col("body"), F.col("plain"))).alias("usual"),
    )
    wrapped = F.expr(f"concat('<{_WRAPPER}>', usual, '</{_WRAPPER}>')")
    parsed = evaluate_once(
        usual, "path", "encoding", "undecoded", "usual", xml=_from_xml(wrapped, nodes))
    parsed = evaluate_once(
        parsed, "path", broken=_TEXT_ERROR, invoices=_invoices(nodes), ascii=_ASCII)
    return _documents(parsed, now, sections)


def good_documents(parsed: DataFrame) -> DataFrame:
    """The documents of the readable files, each built once whatever is done with it later."""
    good = parsed.where(F.col("error").isNull())
    return evaluate_once(good, "source_file", document="document")


def quarantine(parsed: DataFrame) -> DataFrame:
    """Files that could not be read, with the reason."""
    return parsed.where(F.col("error").isNotNull()).select("path", "source_file", "error")


def ingest_summary(parsed: DataFrame) -> DataFrame:
    """How many files were read and how many were not."""
    return parsed.groupBy(F.col("error").isNull().alias("success")).agg(
        F.count("*").alias("files")
    )


def _one_of(c: str, names: tuple[str, ...]) -> str:
    return f"{c} IN ({', '.join(map(literal, names))})"


_START = "hex(substring(content, 1, 2))"
_DECLARED = f"""CASE
    WHEN {_one_of(_START, _BYTE_ORDER_MARKS)} THEN '{_UTF16}'
    WHEN startswith(content, X'3C3F786D6C') OR startswith(content, X'EFBBBF') THEN lower(regexp_extract(
        decode(substring(content, 1, instr(CAST(content AS STRING), '?>') + 4), 'ISO-8859-1'), {literal(_DECLARED_ENCODING)}, 1))
    WHEN content IS NOT NULL THEN ''
    END"""
_KNOWN_ENCODINGS = (*_UTF8_NAMES, *_ASCII_NAMES, *_LATIN1_NAMES, *_WINDOWS_NAMES, _UTF16)

# Text of a file by its encoding; null if the encoding is unknown or the bytes not valid in it.
_UTF8_TEXT = "try_validate_utf8(CAST(content AS STRING))"
_DECODED = f"""CASE
    WHEN {_one_of("encoding", _UTF8_NAMES)} THEN {_UTF8_TEXT}
    WHEN {_one_of("encoding", _LATIN1_NAMES)} THEN decode(content, 'ISO-8859-1')
    WHEN {_one_of("encoding", _WINDOWS_NAMES)} THEN
        translate(decode(content, 'ISO-8859-1'), {literal(_WINDOWS_FROM)}, {literal(_WINDOWS_TO)})
    WHEN {_one_of("encoding", _ASCII_NAMES)} THEN
        if(octet_length(content) = char_length({_UTF8_TEXT}), {_UTF8_TEXT}, NULL)
    WHEN encoding = '{_UTF16}' AND octet_length(content) % 2 = 0 AND NOT hex(content) RLIKE
        if({_START} = '{_BYTE_ORDER_MARKS[0]}', '{_HALF_PAIRS[0]}', '{_HALF_PAIRS[1]}')
        THEN decode(content, 'UTF-16')
    END"""

# Why a file's text cannot be read, null if it can. Spark's parser stops at the end of the first
# element, so a second root or text beside the root must be looked for: exactly one element may
# stand in the wrapper, and nothing else.
_TEXT_ERROR = f"""CASE
    WHEN NOT {_one_of("encoding", _KNOWN_ENCODINGS)} THEN '{UNSUPPORTED_ENCODING}'
    WHEN undecoded THEN '{INVALID_ENCODING}'
    WHEN usual IS NULL OR xml IS NULL OR xml.corrupt IS NOT NULL
        OR coalesce(array_size(xml.nfeProc), 0) + coalesce(array_size(xml.NFe), 0) + coalesce(array_size(xml.other), 0) <> 1
        OR {strip("xml.beside")} <> ''
        THEN '{MALFORMED_XML}'
    END"""


# Whether all texts in a file are ASCII: its own is, and no reference to a character makes another.
_ASCII = "octet_length(usual) = char_length(usual) AND NOT contains(usual, '&#')"


def _file_schema(nodes: T.StructType) -> T.StructType:
    """What can stand in a file: an invoice with or without its envelope, or anything else."""
    return T.StructType([
        T.StructField("nfeProc", T.ArrayType(nodes)),
        T.StructField("NFe", nodes["NFe"].dataType),
        T.StructField("other", T.ArrayType(T.StringType())),
        T.StructField("beside", T.StringType()),
        T.StructField("corrupt", T.StringType()),
    ])


def _from_xml(text: Column, nodes: T.StructType) -> Column:
    return F.from_xml(text, _file_schema(nodes), {
        "ignoreNamespace": "true",
        "ignoreSurroundingSpaces": "false",
        "wildcardColName": "other",
        "valueTag": "beside",
        "columnNameOfCorruptRecord": "corrupt",
    })


def _invoices(nodes: T.StructType) -> Column:
    """The root's invoice nodes (NFe and protNFe)."""
    protocol = nodes["protNFe"].dataType.simpleString()
    bare = f"named_struct('NFe', xml.NFe, 'protNFe', CAST(NULL AS {protocol}))"
    return F.expr(f"if(xml.NFe IS NOT NULL, {bare}, get(xml.nfeProc, 0))")


def _children(parents: str, path: str) -> str:
    """All elements at `path` below an array of elements, in document order; null if there are none."""
    for name in path.split("/"):
        many = f"flatten(filter({parents}.{name}, e -> e IS NOT NULL))"
        parents = f"if(size({parents}) = 1, get({parents}, 0).{name}, {many})"  # no loop for the usual one
    return parents


def _first(elements: str) -> str:
    return f"get({elements}, 0)"


def _leaf(node: str, path: str, kind: str = "string") -> str:
    """Stripped text of the first element at `path` below `node`."""
    parent, _, name = path.rpartition("/")
    text = _first(_children(f"{node}.{parent}", name) if parent else f"{node}.{name}")
    return _TEXTS[kind](text, "ascii")


_TEXTS = {"string": strip, "double": number_text, "int": number_text}
# From stripped text; a blank one is none.
_READERS = {"string": blank_to_null, "double": read_float, "int": read_int}


def _section_texts(s: contract.Section) -> str:
    """A section's texts, stripped, under the contract's names or those of taxpayer documents."""
    texts = {f.name: _leaf(s.name, f.xml, f.type) for f in s.fields if f.xml}
    if any(f.name == "documento" for f in s.fields):
        texts |= {kind: _leaf(s.name, kind) for kind in contract.TAXPAYER_DOCUMENTS}
    return _record(texts)


def _section(s: contract.Section) -> str:
    values = {}
    for f in s.fields:
        if f.name == "documento":
            kinds = [blank_to_null(f"{s.name}.{kind}") for kind in contract.TAXPAYER_DOCUMENTS]
            values[f.name] = f"coalesce({', '.join(kinds)})"
        elif f.name == "tipo_documento":
            cases = [f"WHEN {s.name}.{kind} <> '' THEN '{kind}'" for kind in contract.TAXPAYER_DOCUMENTS]
            values[f.name] = f"CASE {' '.join(cases)} END"
        else:
            values[f.name] = _READERS[f.type](f"{s.name}.{f.name}")
    return _record(values)


def _items() -> str:
    """Contract lines of the array `det`; of a line's `prod` and `imposto` the first counts."""
    texts, values = {}, {}
    for f in contract.ITEMS.fields:
        parent, _, name = f.xml.rpartition("/")
        text = _first(f"{_first(f'd.{parent}')}.{name}") if parent else f"d._{name[1:]}"
        texts[f.name] = _TEXTS[f.type](text, "ascii")
        values[f.name] = _READERS[f.type](f"t.{f.name}")
    return f"transform(transform(det, d -> {_record(texts)}), t -> {_record(values)})"


def _record(values: dict[str, str]) -> str:
    return f"named_struct({', '.join(f'{literal(k)}, {v}' for k, v in values.items())})"


def _documents(parsed: DataFrame, now: str, sections: tuple[str, ...] | None) -> DataFrame:
    wanted = contract.sections_of(sections)
    nodes = parsed.selectExpr(
        "path", "broken", "ascii", f"{basename('path')} AS source_file",
        f"{_children('invoices.NFe', 'infNFe')} AS infNFe", "invoices.protNFe AS protNFe",
    ).selectExpr(
        "path", "broken", "ascii", "source_file",
        f"{_first('infNFe')}._Id AS id",
        f"{_first(_children('protNFe', 'infProt'))} AS protocol",
        f"{_children('infNFe', 'det')} AS det",
        *(f"{_first(_children(*s.node.split('/', 1)))} AS {s.name}" for s in wanted),
    )
    number = "coalesce(d._nItem, '')"
    error = f"""coalesce(broken, if(
        exists(det, d -> {number} <> '' AND NOT {is_integer(number_text(number))}),
        '{INVALID_ITEM_NUMBER}', NULL))"""
    texts = nodes.selectExpr(
        "path", "source_file", f"{error} AS error", "ascii", "id", "det",
        f"{_leaf('protocol', 'chNFe')} AS key",
        *(f"{_section_texts(s)} AS {s.name}" for s in wanted),
    )
    fallback = f"if(id <> '', {remove_first('id', 'NFe')}, NULL)"
    fields = {
        "source_file": "source_file",
        "ingestion_ts": utc_seconds(now),
        "chave_nfe": f"coalesce({blank_to_null('key')}, {fallback})",
        **{s.name: _section(s) for s in wanted},
    }
    if sections is None or contract.ITEMS.name in sections:
        fields[contract.ITEMS.name] = f"coalesce({_items()}, array())"
    return texts.selectExpr(
        "path", "source_file", "error", f"if(error IS NULL, {_record(fields)}, NULL) AS document"
    )
