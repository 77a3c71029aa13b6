"""The invoice contract: one table of fields from which every schema and column list is generated.

A document travels through the engine as one nested record. Its fields, their place in the
invoice XML and their column names in the silver tables are stated here once; the XML schema,
the JSON schema and the silver projections are all derived from this table.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T


class Field(NamedTuple):
    name: str
    xml: str | None  # path below the section's XML node; None: derived by a rule
    type: str = "string"


class Section(NamedTuple):
    name: str
    node: str  # path of the section's XML node
    prefix: str  # prefix of its columns in the silver header
    fields: tuple[Field, ...]


# The invoice layout's namespace, the contract's field names and types, their
# XML paths, and the names of the layer tables and columns.
NAMESPACE = "http://www.portalfiscal.inf.br/nfe"

IDENTITY = (Field("source_file", None), Field("ingestion_ts", None), Field("chave_nfe", None))

SECTIONS = (
    Section("header", "infNFe/ide", "", (
        Field("numero_nota", "nNF"),
        Field("serie", "serie"),
        Field("data_emissao", "dhEmi"),
        Field("data_saida_entrada", "dhSaiEnt"),
        Field("natureza_operacao", "natOp"),
        Field("tipo_nota", "tpNF"),
        Field("finalidade", "finNFe"),
    )),
    Section("emitente", "infNFe/emit", "emit_", (
        Field("documento", None),
        Field("tipo_documento", None),
        Field("nome", "xNome"),
        Field("fantasia", "xFant"),
        Field("municipio", "enderEmit/xMun"),
        Field("uf", "enderEmit/UF"),
    )),
    Section("destinatario", "infNFe/dest", "dest_", (
        Field("documento", None),
        Field("tipo_documento", None),
        Field("nome", "xNome"),
        Field("municipio", "enderDest/xMun"),
        Field("uf", "enderDest/UF"),
        Field("email", "email"),
    )),
    Section("totais", "infNFe/total/ICMSTot", "", (
        Field("valor_produtos", "vProd", "double"),
        Field("valor_nota", "vNF", "double"),
        Field("valor_total_tributos", "vTotTrib", "double"),
        Field("valor_desconto", "vDesc", "double"),
        Field("valor_frete", "vFrete", "double"),
    )),
    Section("protocolo", "protNFe/infProt", "", (
        Field("numero_protocolo", "nProt"),
        Field("status_codigo", "cStat"),
        Field("status_motivo", "xMotivo"),
        Field("data_recebimento", "dhRecbto"),
    )),
)

ITEMS = Section("itens", "infNFe/det", "", (
    Field("n_item", "@nItem", "int"),
    Field("codigo_produto", "prod/cProd"),
    Field("descricao_produto", "prod/xProd"),
    Field("ncm", "prod/NCM"),
    Field("cfop", "prod/CFOP"),
    Field("unidade_comercial", "prod/uCom"),
    Field("quantidade_comercial", "prod/qCom", "double"),
    Field("valor_unitario_comercial", "prod/vUnCom", "double"),
    Field("valor_produto", "prod/vProd", "double"),
    Field("valor_desconto", "prod/vDesc", "double"),
    Field("valor_total_tributos_item", "imposto/vTotTrib", "double"),
))

# Taxpayer document elements in order of precedence; the element name is the document type.
TAXPAYER_DOCUMENTS = ("CNPJ", "CPF")

LINEAGE = ("topic", "partition", "offset", "kafka_timestamp", "processed_at")

BRONZE = "bronze_nfe_json"
SILVER_HEADER = "silver_nfe_header"
SILVER_ITEM = "silver_nfe_item"
GOLD_EMITENTE = "gold_nfe_por_emitente"
GOLD_UF_DESTINO = "gold_nfe_por_uf_destino"
GOLD_TOP_VALOR = "gold_top_produtos_valor"
GOLD_TOP_QUANTIDADE = "gold_top_produtos_quantidade"
LAYER_TABLES = (
    BRONZE, SILVER_HEADER, SILVER_ITEM,
    GOLD_EMITENTE, GOLD_UF_DESTINO, GOLD_TOP_VALOR, GOLD_TOP_QUANTIDADE,
)
ANALYTICS_EMITENTE = "analytics_01_emitente"
ANALYTICS_UF_DESTINO = "analytics_02_uf_destino"
ANALYTICS_TOP_VALOR = "analytics_03_top_produtos_valor"
ANALYTICS_TOP_QUANTIDADE = "analytics_04_top_produtos_quantidade"
ANALYTICS_TRIBUTOS = "analytics_05_tributos_emitente"
ANALYTICS_TABLES = (
    ANALYTICS_EMITENTE, ANALYTICS_UF_DESTINO, ANALYTICS_TOP_VALOR,
    ANALYTICS_TOP_QUANTIDADE, ANALYTICS_TRIBUTOS,
)

QUARANTINE = "quarantine_nfe_xml"

MESSAGE_LOG_SCHEMA = (
    "topic string, partition int, offset bigint, timestamp timestamp, key binary, value binary"
)
# End of the fixed values.

_TYPES = {"string": T.StringType(), "double": T.DoubleType(), "int": T.IntegerType()}


def struct_of(fields: tuple[Field, ...]) -> T.StructType:
    return T.StructType([T.StructField(f.name, _TYPES[f.type]) for f in fields])


def document_schema(sections: tuple[str, ...] | None = None) -> T.StructType:
    """Schema of a document; `sections` narrows it to what a reader needs (identity is always in)."""
    out = [T.StructField(f.name, _TYPES[f.type]) for f in IDENTITY]
    out += [T.StructField(s.name, struct_of(s.fields)) for s in sections_of(sections)]
    if _wanted(ITEMS, sections):
        out.append(T.StructField(ITEMS.name, T.ArrayType(struct_of(ITEMS.fields))))
    return T.StructType(out)


def _wanted(s: Section, sections: tuple[str, ...] | None) -> bool:
    return sections is None or s.name in sections


def header_columns(sections: tuple[str, ...] | None = None) -> list[tuple[str, str]]:
    """(path inside the document, silver header column) in table order, identity first."""
    out = [(name, name) for name in ("chave_nfe", "source_file", "ingestion_ts")]
    for s in sections_of(sections):
        out += [(f"{s.name}.{f.name}", s.prefix + f.name) for f in s.fields]
    return out


def item_columns() -> list[str]:
    return [f.name for f in ITEMS.fields]


def _element_schema(paths: list[str]) -> T.StructType:
    """XML schema covering `paths`: every element is repeatable, `@x` is an attribute."""
    children: dict[str, list[str]] = {}
    for path in paths:
        head, _, rest = path.partition("/")
        children.setdefault(head, []).extend([rest] if rest else [])
    out = []
    for name, rest in children.items():
        if name.startswith("@"):
            out.append(T.StructField("_" + name[1:], T.StringType()))
        else:
            element = _element_schema(rest) if rest else T.StringType()
            out.append(T.StructField(name, T.ArrayType(element)))
    return T.StructType(out)


def xml_schema(sections: tuple[str, ...] | None = None) -> T.StructType:
    """Schema of the elements that can stand at or directly below a document's root.

    What identifies an invoice and its line numbers are always in.
    """
    paths = ["NFe/infNFe/@Id", "NFe/infNFe/det/@nItem", "protNFe/infProt/chNFe"]
    for s in (*SECTIONS, ITEMS):
        if _wanted(s, sections):
            node = s.node if s.node.startswith("protNFe") else "NFe/" + s.node
            paths += [f"{node}/{f.xml}" for f in s.fields if f.xml]
            if any(f.name == "tipo_documento" for f in s.fields):
                paths += [f"{node}/{kind}" for kind in TAXPAYER_DOCUMENTS]
    return _element_schema(list(dict.fromkeys(paths)))


def xml_names() -> tuple[tuple[str, ...], tuple[str, ...], tuple[str, ...]]:
    """Names of the elements with children, of those with text, and of the attributes, each once."""
    nodes, leaves, attributes = [], [], []

    def collect(schema: T.StructType) -> None:
        for field in schema:
            if field.name.startswith("_"):
                attributes.append(field.name[1:])
            elif isinstance(field.dataType.elementType, T.StructType):
                nodes.append(field.name)
                collect(field.dataType.elementType)
            else:
                leaves.append(field.name)

    collect(xml_schema())
    return tuple(tuple(dict.fromkeys(names)) for names in (["nfeProc", *nodes], leaves, attributes))


def sections_of(names: tuple[str, ...] | None) -> tuple[Section, ...]:
    """The named one-per-invoice sections, all without names."""
    return tuple(s for s in SECTIONS if _wanted(s, names))
