"""Contract documents -> invoice XML text, the inverse of parsing."""

from __future__ import annotations

from invoicelake import contract
from invoicelake.functions.text import literal

# Money has two decimal places in the layout, quantities and unit prices more.
_SCALES = {"quantidade_comercial": 4, "valor_unitario_comercial": 4}


def invoice_xml(document: str, sections: tuple[str, ...] | None = None) -> str:
    """The document as an `nfeProc` text (a SQL expression); only `sections` are written.

    Null fields are left out.
    """
    paths = {"@xmlns": literal(contract.NAMESPACE)}
    paths["NFe/infNFe/@Id"] = f"concat('NFe', {document}.chave_nfe)"
    for s in contract.sections_of(sections):
        node = s.node if s.node.startswith("protNFe") else "NFe/" + s.node
        for path, value in _values(f"{document}.{s.name}", s).items():
            paths[f"{node}/{path}"] = value
    if sections is None or "itens" in sections:
        line = _nested(_values("i", contract.ITEMS))
        paths["NFe/infNFe/det"] = f"transform({document}.itens, i -> {line})"
    if sections is None or "protocolo" in sections:
        paths["protNFe/infProt/chNFe"] = f"{document}.chave_nfe"
    return f"to_xml({_nested(paths)}, map('rowTag', 'nfeProc', 'indent', ''))"


def _values(node: str, s: contract.Section) -> dict[str, str]:
    values = {}
    for f in s.fields:
        if f.name == "documento":
            for kind in contract.TAXPAYER_DOCUMENTS:
                values[kind] = f"if({node}.tipo_documento = '{kind}', {node}.documento, NULL)"
        elif f.xml:
            value = f"{node}.{f.name}"
            if f.type == "double":
                value = f"CAST({value} AS DECIMAL(18,{_SCALES.get(f.name, 2)}))"
            values[f.xml] = value
    return values


def _nested(paths: dict[str, str]) -> str:
    """`named_struct` text with the values at their paths."""
    children: dict[str, dict[str, str] | str] = {}
    for path, value in paths.items():
        head, _, rest = path.partition("/")
        name = "_" + head[1:] if head.startswith("@") else head
        if rest:
            children.setdefault(name, {})[rest] = value
        else:
            children[name] = value
    fields = (
        f"{literal(name)}, {_nested(v) if isinstance(v, dict) else v}" for name, v in children.items()
    )
    return f"named_struct({', '.join(fields)})"
