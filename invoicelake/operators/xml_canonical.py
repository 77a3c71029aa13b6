"""Unusual invoice files in the usual form.

Names in XML belong to namespaces, whose prefixes hold for parts of a document, and an invoice may
stand at any depth. Spark's reader knows neither. Files that are not in the usual form as they are
(`PLAIN`, a test of columns) are rewritten to it by a streaming parser in Python workers:
the invoice elements wherever they stand, by namespace and exact name, each leaf with its text up to
the first child.
"""

from __future__ import annotations

from xml.parsers import expat
from xml.sax.saxutils import escape, quoteattr

import pandas as pd
from pyspark.sql import Column, functions as F

from invoicelake import contract
from invoicelake.functions.text import literal

# Fixed value: the namespace of the signature that every sent invoice carries.
SIGNATURE_NAMESPACE = "http://www.w3.org/2000/09/xmldsig#"

NODES, LEAVES, ATTRIBUTES = contract.xml_names()
_ROOTS = ("infNFe", "protNFe")  # elements that count at any depth below the root

_BOUND = rf"\s(?:[^<>]*?\s)?xmlns=\x22{contract.NAMESPACE.replace('.', '[.]')}\x22[^<>]*+>\s*+"
_USUAL_START = rf"^\s*+<(?:nfeProc{_BOUND}<NFe(?:\s[^<>]*+)?>\s*+|NFe{_BOUND})<infNFe[\s>]"
_OTHER_NAMESPACE = rf"xmlns(?!=\x22{contract.NAMESPACE}\x22)(?!=\x22{SIGNATURE_NAMESPACE}\x22)"
_OTHER_SIGNATURE = rf"(?<!<Signature )xmlns=\x22{SIGNATURE_NAMESPACE}\x22"
# The name of every start tag; if a child follows, with all that stands before the child.
_NAMES = r"<([\w.:-]++(?:(?:\s[^<>]*+)?(?<!/)>[^<]*+(?=<[^/]))?)"
# Among those names but for the contract's: a prefixed one, a leaf with a child, one that differs by case.
_CONTRACT, _LEAF = "|".join(NODES + LEAVES), "|".join(LEAVES)
_UNUSUAL_NAMES = (
    rf"<(?:[\w.-]*+:|(?:{_LEAF})[\s>]|(?!(?:{_CONTRACT})[\s>])(?i:{_CONTRACT})(?:[\s<>]|$))"
)


def _one_of(names: tuple[str, ...]) -> str:
    """A pattern of the names, told apart by their first letters."""
    ends: dict[str, list[str]] = {}
    for name in names:
        ends.setdefault(name[0], []).append(name[1:])
    return "(?:" + "|".join(f"{first}(?:{'|'.join(rest)})" for first, rest in ends.items()) + ")"


# One pass over a text in which no name is unusual: end tags, nodes, leaves without a child, other names. It may fail
# on texts without unusual names (letters beyond ASCII, say), never match one with. No group is called from itself:
# a possessive loop runs in one call.
_NO_UNUSUAL_NAMES = (
    rf"^[^<]*+(?:<(?:/[^<]*+|{_one_of(NODES)}(?=[\s/>])[^<]*+"
    rf"|{_one_of(LEAVES)}(?:\s[^<>]*+|/)?+>(?:(?<=/>)[^<]*+|[^<]*+(?=</))"
    rf"|(?!(?i:{_one_of(NODES + LEAVES)})(?:[\s<>/]|$))[\w.-]++(?=[\s/>])[^<]*+))*+\z"
)


def _again(name: str) -> str:
    return f"regexp_count(body, '<{name}[\\\\s/>]')"


def _array(names: tuple[str, ...]) -> str:
    return f"array({', '.join(map(literal, names))})"


# Whether the text `body` needs no rewriting: one invoice where Spark's reader looks for it, without
# comments, CDATA and other declarations, all of its names unprefixed and in the invoice namespace (but for the
# signature), none that differs from a name of the contract by case only, and no leaf with children.
# Text that merely looks unusual is rewritten without harm.
PLAIN = f"""(
    body RLIKE {literal(_USUAL_START)}
    AND NOT contains(body, '<!') AND NOT contains(body, '<?')
    AND NOT body RLIKE {literal(_OTHER_NAMESPACE)}
    AND NOT (contains(body, {literal(SIGNATURE_NAMESPACE)}) AND body RLIKE {literal(_OTHER_SIGNATURE)})
    AND {_again('NFe')} = 1 AND {_again('infNFe')} = 1
    AND (NOT contains(body, '<protNFe') OR {_again('protNFe')} = 0
         OR {_again('protNFe')} = 1 AND body RLIKE '</NFe>\\s*+<protNFe[\\s/>]')
    AND (body RLIKE {literal(_NO_UNUSUAL_NAMES)} OR NOT concat('<', array_join(
        array_except(regexp_extract_all(body, {literal(_NAMES)}, 1), {_array(NODES + LEAVES)}),
        '<')) RLIKE {literal(_UNUSUAL_NAMES)}))"""


class _Usual:
    """Takes a parser's events and keeps the elements of the contract."""

    def __init__(self) -> None:
        self.found: dict[str, list[list[str]]] = {name: [] for name in _ROOTS}
        self.depth = 0
        # Of each open invoice element: its depth, its text so far, and the depth of an element in it
        # whose content does not count (0: none). One may stand in another.
        self.spans: list[list] = []
        self.leaf_text = False  # inside a leaf, before its first child

    def start(self, name: str, attributes: dict[str, str]) -> None:
        uri, _, local = name.rpartition(" ")
        known = uri == contract.NAMESPACE and (local in NODES or local in LEAVES)
        self.leaf_text = False
        if known and local in _ROOTS and self.depth:
            text: list[str] = []
            self.found[local].append(text)
            self.spans.append([self.depth, text, 0])
        for span in self.spans:
            if span[2]:
                continue
            if not known or (local in _ROOTS and self.depth > span[0]):
                span[2] = self.depth
                continue
            kept = "".join(
                f" {key}={quoteattr(attributes[key])}" for key in ATTRIBUTES if key in attributes)
            span[1].append(f"<{local}{kept}>")
            if local in LEAVES:
                span[2] = -self.depth  # texts count, elements in it do not
                self.leaf_text = True
        self.depth += 1

    def data(self, text: str) -> None:
        if self.leaf_text:
            for span in self.spans:
                if span[2] == 1 - self.depth:
                    span[1].append(escape(text))

    def end(self, name: str) -> None:
        self.depth -= 1
        self.leaf_text = False
        local = name.rpartition(" ")[2]
        for span in self.spans:
            if span[2] == self.depth and span[2]:
                span[2] = 0
            elif not span[2] or span[2] == -self.depth:
                span[1].append(f"</{local}>")
                span[2] = 0
        if self.spans and self.spans[-1][0] == self.depth:
            self.spans.pop()

    def doctype(self, *_: object) -> None:
        raise expat.ExpatError("documents with a DTD are not read")

    def text(self) -> str:
        invoices, protocols = ("".join(map("".join, self.found[name])) for name in _ROOTS)
        return f"<nfeProc><NFe>{invoices}</NFe>{protocols}</nfeProc>"


def usual_form(text: str | None) -> str | None:
    """The document in the usual form, null if it is not well-formed or has a DTD."""
    if text is None:
        return None
    events = _Usual()
    parser = expat.ParserCreate("utf-8", namespace_separator=" ")
    parser.buffer_text = True
    parser.StartElementHandler = events.start
    parser.EndElementHandler = events.end
    parser.CharacterDataHandler = events.data
    parser.StartDoctypeDeclHandler = events.doctype
    try:
        parser.Parse(text.encode(), True)
    except expat.ExpatError:
        return None
    return events.text()


def _usual_forms(texts: pd.Series) -> pd.Series:
    return texts.map(usual_form, na_action="ignore")


def rewritten(body: Column, plain: Column) -> Column:
    """The usual form of texts that are not plain; plain ones never leave the JVM."""
    return F.pandas_udf(_usual_forms, "string")(F.when(~plain, body))
