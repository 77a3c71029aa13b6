"""Every branch of reading an invoice file, on small invented documents."""

import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import NS, invoice
from invoicelake.functions.text import literal
from invoicelake.operators import xml_canonical
from invoicelake.operators.xml_canonical import PLAIN

DET = '<det nItem="1"><prod><cProd>P1</cProd><xProd>Um</xProd><vProd>{}</vProd></prod></det>'


def det(number='nItem="1"', prod="<cProd>P1</cProd>", imposto=""):
    return f"<det {number}><prod>{prod}</prod>{imposto}</det>"


GOOD = {
    "full": invoice(
        ide="<nNF>307</nNF><serie>1</serie><dhEmi>2021-01-29T10:32:11-03:00</dhEmi>"
            "<dhSaiEnt>2021-01-29T11:00:00-03:00</dhSaiEnt><natOp>VENDA</natOp><tpNF>1</tpNF><finNFe>1</finNFe>",
        emit="<emit><CNPJ>01</CNPJ><xNome>Café Ltda</xNome><xFant>Café</xFant><enderEmit>"
             "<xMun>São Paulo</xMun><UF>SP</UF></enderEmit></emit>",
        dest="<dest><CPF>02</CPF><xNome>Ana</xNome><enderDest><xMun>Natal</xMun><UF>RN</UF></enderDest>"
             "<email>a@example.org</email></dest>",
        det='<det nItem="1"><prod><cProd>7</cProd><cEAN/><xProd>Milho</xProd><NCM>0020</NCM><CFOP>5102</CFOP>'
            "<uCom>UN</uCom><qCom>6.0000</qCom><vUnCom>4.7824000000</vUnCom><vProd>28.69</vProd>"
            "<vDesc>0.10</vDesc></prod><imposto><vTotTrib>1.68</vTotTrib></imposto></det>",
        total="<total><ICMSTot><vProd>28.69</vProd><vFrete>0.00</vFrete><vDesc>0.10</vDesc>"
              "<vNF>28.59</vNF><vTotTrib>1.68</vTotTrib></ICMSTot></total>",
        protocol="<nProt>9</nProt><cStat>100</cStat><xMotivo>Autorizado</xMotivo><dhRecbto>d</dhRecbto>",
    ),
    "declaration": '<?xml version="1.0" encoding="UTF-8"?>\n' + invoice(),
    "bom": b"\xef\xbb\xbf" + ('<?xml version="1.0" encoding="utf-8"?>' + invoice(ide="<natOp>é</natOp>")).encode(),
    "latin1": ('<?xml version="1.0" encoding="ISO-8859-1"?>' + invoice(ide="<natOp>ação</natOp>")).encode("latin-1"),
    "windows": ('<?xml version="1.0" encoding="windows-1252"?>' + invoice(ide="<natOp>5€ ação</natOp>")).encode("cp1252"),
    "ascii": b'<?xml version="1.0" encoding="US-ASCII"?>' + invoice().encode(),
    "utf16": ('<?xml version="1.0" encoding="UTF-16"?>' + invoice(ide="<natOp>ação \U0001f600</natOp>")).encode("utf-16"),
    "utf16_be": b"\xfe\xff" + invoice(ide="<natOp>ação \U0001f600</natOp>").encode("utf-16-be"),
    "no_protocol": invoice(key=None, id_='Id="NFe42"'),
    "empty_key": invoice(key="<chNFe/>", id_='Id="NFe1NFe2"'),
    "blank_key": invoice(key="<chNFe> </chNFe>", id_='Id="9"'),
    "no_key_no_id": invoice(key=None, id_=""),
    "id_only_prefix": invoice(key=None, id_='Id="NFe"'),
    "both_documents": invoice(emit="<emit><CPF>2</CPF><CNPJ>1</CNPJ></emit>"),
    "blank_cnpj": invoice(emit="<emit><CNPJ> </CNPJ><CPF>2</CPF></emit>"),
    "no_documents": invoice(emit="<emit><xNome>x</xNome></emit>"),
    "no_parents": invoice(),
    "blank_texts": invoice(det=det(prod="<cProd/><xProd>  </xProd>")),
    "stripped": invoice(ide="<nNF>\t 7\n</nNF><serie>  8 　</serie><natOp> á b </natOp>"),
    "repeated": invoice(ide="<nNF>1</nNF><nNF>2</nNF><serie/><serie>3</serie>"),
    "markup": invoice(ide="<nNF>a&amp;b</nNF><serie><![CDATA[<c>]]></serie><natOp>1<!-- x -->2</natOp>"),
    "numbers": invoice(det="".join(
        DET.format(v) for v in (
            "1,5", "abc", "1d", "0x1p3", "1e3", "nan", "inf", "-Infinity", "+2", "1_0", ".5", "7.", "1__0", "1e999", " 3 ",
        )
    )),
    "item_numbers": invoice(det="".join(
        det(n) for n in ("", 'nItem=""', 'nItem=" 5 "', 'nItem="007"', 'nItem="99999999999"', 'nItem="+1_0"')
    )),
    "two_prods": invoice(det="<det nItem='1'><prod><cProd>A</cProd></prod><prod><cProd>B</cProd><xProd>b</xProd></prod></det>"),
    "two_invoices": f'<nfeProc xmlns="{NS}"><NFe><infNFe Id="NFe1"><ide><nNF>1</nNF></ide></infNFe></NFe>'
                    f'<NFe><infNFe Id="NFe2"><ide><nNF>2</nNF></ide><emit><xNome>e2</xNome></emit>{det()}</infNFe></NFe></nfeProc>',
    "bare_root": f'<NFe xmlns="{NS}"><infNFe Id="NFe5"><ide><nNF>5</nNF></ide>{det()}</infNFe></NFe>',
    "invoice_root": f'<infNFe xmlns="{NS}" Id="NFe5"><ide><nNF>5</nNF></ide></infNFe>',
    "other_namespace": invoice().replace(NS, "urn:other"),
    "no_namespace": invoice().replace(f' xmlns="{NS}"', ""),
    "prefixed": f'<n:nfeProc xmlns:n="{NS}"><n:NFe><n:infNFe Id="NFe6"><n:ide><n:nNF>6</n:nNF></n:ide></n:infNFe></n:NFe></n:nfeProc>',
    "deep": f"<envelope><!-- <infNFe> --><corpo>{invoice(ide='<nNF>8</nNF>', det=det() * 2)}</corpo></envelope>",
    "deep_prefixed": f'<s:env xmlns:s="urn:s"><n:NFe xmlns:n="{NS}"><n:infNFe Id="NFe6"><n:ide><n:nNF>6</n:nNF></n:ide></n:infNFe></n:NFe></s:env>',
    "batch": f'<enviNFe xmlns="{NS}"><idLote>1</idLote><NFe><infNFe Id="NFeA"><ide><nNF>1</nNF></ide>{det()}</infNFe></NFe>'
             f'<NFe><infNFe Id="NFeB"/></NFe></enviNFe>',
    "unrelated": "<a><b/></a>",
    "prefix_in_text": invoice(ide="<nNF><![CDATA[<x:y>]]></nNF>") + "<!-- <x:y> -->",
    "comments_around": "<!-- a -->\n" + invoice() + "\n<!-- b -->\n<?pi x?>\n",
    "address_split": invoice(emit="<emit><enderEmit><UF>SP</UF></enderEmit><enderEmit><xMun>M</xMun></enderEmit></emit>"),
    "sub dir/x 1.xml": invoice(),
}


@pytest.fixture(scope="module")
def good(parse):
    rows = parse(GOOD)
    assert {name: r.error for name, r in rows.items() if r.error} == {}
    return {name: r.document for name, r in rows.items()}


def test_all_fields(good):
    d = good["full"].asDict(recursive=True)
    assert d == {
        "source_file": "full", "ingestion_ts": "2024-05-06T07:08:09Z", "chave_nfe": "K1",
        "header": {
            "numero_nota": "307", "serie": "1", "data_emissao": "2021-01-29T10:32:11-03:00",
            "data_saida_entrada": "2021-01-29T11:00:00-03:00", "natureza_operacao": "VENDA",
            "tipo_nota": "1", "finalidade": "1",
        },
        "emitente": {
            "documento": "01", "tipo_documento": "CNPJ", "nome": "Café Ltda", "fantasia": "Café",
            "municipio": "São Paulo", "uf": "SP",
        },
        "destinatario": {
            "documento": "02", "tipo_documento": "CPF", "nome": "Ana", "municipio": "Natal",
            "uf": "RN", "email": "a@example.org",
        },
        "totais": {
            "valor_produtos": 28.69, "valor_nota": 28.59, "valor_total_tributos": 1.68,
            "valor_desconto": 0.10, "valor_frete": 0.0,
        },
        "protocolo": {
            "numero_protocolo": "9", "status_codigo": "100", "status_motivo": "Autorizado",
            "data_recebimento": "d",
        },
        "itens": [{
            "n_item": 1, "codigo_produto": "7", "descricao_produto": "Milho", "ncm": "0020",
            "cfop": "5102", "unidade_comercial": "UN", "quantidade_comercial": 6.0,
            "valor_unitario_comercial": 4.7824, "valor_produto": 28.69, "valor_desconto": 0.10,
            "valor_total_tributos_item": 1.68,
        }],
    }


@pytest.mark.parametrize("name, text", [
    ("bom", "é"), ("latin1", "ação"), ("windows", "5€ ação"),
    ("utf16", "ação \U0001f600"), ("utf16_be", "ação \U0001f600"),
])
def test_encodings(good, name, text):
    assert good[name].header.natureza_operacao == text


@pytest.mark.parametrize("name, key", [
    ("full", "K1"), ("declaration", "K1"), ("no_protocol", "42"), ("empty_key", "1NFe2"),
    ("blank_key", "9"), ("no_key_no_id", None), ("id_only_prefix", ""), ("two_invoices", "1"),
    ("bare_root", "5"), ("invoice_root", None), ("other_namespace", None), ("no_namespace", None),
    ("prefixed", "6"), ("deep", "K1"), ("deep_prefixed", "6"), ("batch", "A"), ("unrelated", None),
    ("comments_around", "K1"),
])
def test_access_key(good, name, key):
    assert good[name].chave_nfe == key


@pytest.mark.parametrize("name, document", [
    ("both_documents", ("1", "CNPJ")), ("blank_cnpj", ("2", "CPF")), ("no_documents", (None, None)),
])
def test_taxpayer_document(good, name, document):
    assert (good[name].emitente.documento, good[name].emitente.tipo_documento) == document


def test_missing_parents_give_nulls(good):
    d = good["no_parents"]
    assert set(d.emitente) | set(d.destinatario) | set(d.totais) == {None}
    assert d.itens == []


def test_texts(good):
    assert good["blank_texts"].itens[0].codigo_produto is None
    assert good["blank_texts"].itens[0].descricao_produto is None
    assert good["stripped"].header[:2] == ("7", "8")
    assert good["stripped"].header.natureza_operacao == "á b"
    assert good["repeated"].header[:2] == ("1", None)
    assert good["markup"].header[:2] == ("a&b", "<c>")
    assert good["markup"].header.natureza_operacao == "12"
    assert good["address_split"].emitente.municipio == "M"


def test_numbers(good):
    values = [i.valor_produto for i in good["numbers"].itens]
    assert values[:5] == [None, None, None, None, 1000.0]
    assert math.isnan(values[5])
    assert values[6:] == [math.inf, -math.inf, 2.0, 10.0, 0.5, 7.0, None, math.inf, 3.0]


def test_digits_of_all_scripts(parse):
    texts = ["１２.５", "٣٤", " \u3000𝟙𝟚e２ ", "１_０", "²", "१२,५", "x１", "-๕"]
    numbers = ["１２", " ٣ ", "²"]
    rows = parse({
        "values": invoice(det="".join(DET.format(t) for t in texts), total="<total><ICMSTot><vNF>７</vNF></ICMSTot></total>"),
        **{f"n{i}": invoice(det=det(f'nItem="{n}"')) for i, n in enumerate(numbers)},
    })

    def read(text):
        try:
            return float(text)
        except ValueError:
            return None

    values = rows["values"].document
    assert [i.valor_produto for i in values.itens] == [read(t) for t in texts]
    assert values.totais.valor_nota == 7.0
    assert [rows[f"n{i}"].document.itens[0].n_item for i in (0, 1)] == [12, 3]
    assert rows["n2"].error == "invalid_item_number"


def test_item_numbers(good):
    assert [i.n_item for i in good["item_numbers"].itens] == [None, None, 5, 7, None, 10]


def test_first_prod_of_a_line(good):
    item = good["two_prods"].itens[0]
    assert (item.codigo_produto, item.descricao_produto) == ("A", None)


def test_several_invoices_in_a_file(good):
    d = good["two_invoices"]
    assert (d.header.numero_nota, d.emitente.nome, len(d.itens)) == ("1", "e2", 1)
    assert (good["batch"].header.numero_nota, len(good["batch"].itens)) == ("1", 1)


def test_roots(good):
    assert good["bare_root"].header.numero_nota == "5"
    assert good["invoice_root"].header.numero_nota is None
    assert good["other_namespace"].header.numero_nota is None
    assert good["other_namespace"].itens == []
    assert good["no_namespace"].header.numero_nota is None
    assert good["prefixed"].header.numero_nota == "6"
    assert (good["deep"].header.numero_nota, len(good["deep"].itens)) == ("8", 2)
    assert good["deep_prefixed"].header.numero_nota == "6"


@pytest.mark.parametrize("sections", [(), ("totais",), ("destinatario", "itens"), ("protocolo",)])
def test_sections_narrow_the_documents_only(parse, sections):
    documents = {k: v for docs in (GOOD, *BAD.values()) for k, v in docs.items()}
    full, narrow = parse(documents), parse(documents, sections=sections)
    kept = ["source_file", "ingestion_ts", "chave_nfe", *sections]
    for name, row in full.items():
        assert narrow[name].error == row.error
        if row.document:
            assert sorted(narrow[name].document.asDict()) == sorted(kept)
            for field in kept:
                assert repr(narrow[name].document[field]) == repr(row.document[field])


INF = "<infNFe Id='NFe5'><ide><nNF>5</nNF></ide><det nItem='2'><prod><cProd>P</cProd></prod></det></infNFe>"
UNUSUAL = {
    # Below another element of a known root, or without the element that usually holds it.
    "lot": f'<nfeProc xmlns="{NS}"><lote><NFe>{INF}</NFe></lote></nfeProc>',
    "direct": f'<nfeProc xmlns="{NS}">{INF}</nfeProc>',
    "nested_root": f'<NFe xmlns="{NS}"><a><b><c>{INF}</c></b></a></NFe>',
    "protocol_below": f'<nfeProc xmlns="{NS}"><NFe>{INF}</NFe><ret><protNFe><infProt><chNFe>K5</chNFe></infProt></protNFe></ret></nfeProc>',
    "one_in_another": f'<NFe xmlns="{NS}"><infNFe Id="NFe7"><x>{INF}</x><ide><nNF>7</nNF></ide></infNFe></NFe>',
    # Quoted markup is text.
    "cdata": f'<env xmlns="urn:e"><nota><![CDATA[<NFe xmlns="{NS}"><infNFe Id="NFeBAD"><ide><nNF>66</nNF></ide></infNFe></NFe>]]></nota></env>',
    "cdata_beside": invoice(ide="<nNF>5</nNF>", extra=f'<obs><![CDATA[<infNFe><ide><nNF>66</nNF></ide></infNFe>]]></obs>'),
    "comment": f'<a><!-- <NFe xmlns="{NS}">{INF}</NFe> --></a>',
    # Names belong to a namespace and are exact.
    "other_first": invoice(ide='<x:nNF xmlns:x="urn:o">5</x:nNF><nNF>8</nNF>'),
    "other_default": invoice(ide='<nNF xmlns="urn:o">5</nNF><nNF>8</nNF>'),
    "other_parent": invoice(ide='<nNF>8</nNF>', extra='<emit xmlns="urn:o"><xNome>no</xNome></emit>'),
    "case": invoice(ide="<nnf>5</nnf><serie>1</serie>"),
    "case_parent": f'<nfeProc xmlns="{NS}"><NFe><INFNFE><ide><nNF>5</nNF></ide></INFNFE></NFe></nfeProc>',
    "rebound": f'<n:a xmlns:n="urn:a"><n:b xmlns:n="{NS}"><n:infNFe Id="NFe1"><n:ide><n:nNF>1</n:nNF></n:ide></n:infNFe></n:b><n:infNFe Id="NFe2"/></n:a>',
    "two_prefixes": f'<p:NFe xmlns:p="{NS}" xmlns:q="{NS}"><q:infNFe Id="NFe3"><p:ide><q:nNF>3</q:nNF></p:ide></q:infNFe></p:NFe>',
    "attribute_of_other": invoice(id_='x:Id="NFe9" xmlns:x="urn:o"', key=None),
    # Text up to the first child.
    "mixed": invoice(ide="<nNF>1<k/>2</nNF><serie>3<k>4</k></serie><natOp><k/>5</natOp>"),
    "mixed_comment": invoice(ide="<nNF>1<!-- k -->2<k/>3</nNF>"),
    "greater_in_attribute": f'<nfeProc xmlns="{NS}"><NFe a="x>y"><infNFe b=\'">\' Id="NFe4"><ide><nNF>4</nNF></ide></infNFe></NFe></nfeProc>',
    "signed": f'<nfeProc versao="4.00" xmlns="{NS}"><NFe xmlns="{NS}"><infNFe Id="NFe6"><ide><nNF>6</nNF></ide></infNFe>'
              '<Signature xmlns="http://www.w3.org/2000/09/xmldsig#"><SignedInfo/></Signature></NFe></nfeProc>',
}


def test_unusual_files(parse):
    rows = parse(UNUSUAL)
    assert {name: r.error for name, r in rows.items() if r.error} == {}
    docs = {name: r.document for name, r in rows.items()}
    numbers = {name: d.header.numero_nota for name, d in docs.items()}
    assert numbers == {
        "lot": "5", "direct": "5", "nested_root": "5", "protocol_below": "5", "one_in_another": "7",
        "cdata": None, "cdata_beside": "5", "comment": None, "other_first": "8", "other_default": "8",
        "other_parent": "8", "case": None, "case_parent": None, "rebound": "1", "two_prefixes": "3",
        "attribute_of_other": "1", "mixed": "1", "mixed_comment": "12", "greater_in_attribute": "4",
        "signed": "6",
    }
    assert {n: docs[n].chave_nfe for n in ("lot", "direct", "protocol_below", "cdata", "attribute_of_other")} == {
        "lot": "5", "direct": "5", "protocol_below": "K5", "cdata": None, "attribute_of_other": None}
    assert [len(docs[n].itens) for n in ("lot", "direct", "nested_root", "one_in_another", "cdata")] == [1, 1, 1, 1, 0]
    assert docs["lot"].itens[0].n_item == 2 and docs["case"].header.serie == "1"
    assert docs["other_parent"].emitente.nome is None
    assert (docs["mixed"].header.serie, docs["mixed"].header.natureza_operacao) == ("3", None)


def test_one_pass_over_names_accepts_no_unusual_one(spark):
    """What the quick test accepts has no unusual name by the full one, and it does accept usual files."""
    one, full = (F.expr(f"body RLIKE {literal(p)}") for p in (
        xml_canonical._NO_UNUSUAL_NAMES, xml_canonical._UNUSUAL_NAMES))
    names = F.expr(f"regexp_extract_all(body, {literal(xml_canonical._NAMES)}, 1)")
    known = F.expr(xml_canonical._array(xml_canonical.NODES + xml_canonical.LEAVES))
    usual = invoice(ide="<nNF a='>'>1</nNF><serie/><serie a='1'/><other><deep x='2'>t</deep></other>",
                    det="<det nItem='1'><prod><cProd>a</cProd></prod></det>" * 30000)
    pieces = ["<NNF/>", "<nnf>1</nnf>", "<n:nNF>1</n:nNF>", "<nNF>1<x/></nNF>", "<nNF a='1'>1<x/></nNF>", "<x.y/>",
              "<nNF>1</nNF>", "<NFE>", "<ide\n>", "<\u00e9/>", "<x-ide>", "<nNF/><x/>", "<PROD", "<ide a:b='1'><x/>"]
    rng = random.Random(5)
    texts = [usual] + ["".join(rng.choices(pieces, k=rng.randint(1, 4))) for _ in range(400)]
    rows = spark.createDataFrame([(t,) for t in texts], "body string").select(
        one.alias("quick"), F.concat(F.lit("<"), F.array_join(F.array_except(names, known), "<")).alias("body")
    ).select("quick", full.alias("unusual")).collect()
    assert rows[0].quick and 5 < sum(r.quick for r in rows) < 395
    assert not [r for r in rows if r.quick and r.unusual]


def test_usual_files_stay_in_the_jvm(spark):
    usual = [GOOD["full"], invoice(), UNUSUAL["signed"], GOOD["bare_root"]]
    texts = spark.createDataFrame([(t,) for t in usual + [UNUSUAL["lot"], UNUSUAL["mixed"], "<a", ""]], "body string")
    assert [r.plain for r in texts.selectExpr(f"{PLAIN} AS plain").collect()] == [True] * 4 + [False] * 4


@pytest.mark.parametrize("name", [n for n in GOOD if isinstance(GOOD[n], str) and not GOOD[n].startswith("<?")])
def test_rewriting_changes_no_value(parse, name):
    """Files that are read as they are give the same document when they are rewritten."""
    forced = f"<!-- rewritten -->{GOOD[name]}"
    got = parse({"a": GOOD[name], "b": forced})
    strip = lambda d: {k: repr(v) for k, v in d.asDict().items() if k != "source_file"}
    assert strip(got["a"].document) == strip(got["b"].document)


def test_source_file_is_the_base_name(good):
    assert good["x 1.xml"].source_file == "x 1.xml"


BAD = {
    "malformed_xml": {
        "empty": "", "blank": " \n", "text": "plain text",
        "truncated": invoice()[:-12], "mismatched": "<a><b></a></b>",
        "trailing": invoice() + " junk", "leading": "junk" + invoice(),
        "two_roots": invoice() + invoice(), "ampersand": invoice(ide="<nNF>a & b</nNF>"),
        "late_declaration": " " + '<?xml version="1.0"?>' + invoice(),
        "entities": '<!DOCTYPE a [<!ENTITY e "x">]>' + invoice(ide="<nNF>&e;</nNF>"),
        "unbound_prefix": invoice().replace("infNFe", "n:infNFe"),
        "wrapper": "</invoice-file><invoice-file>" + invoice(),
    },
    "invalid_item_number": {
        "letter": invoice(det=det('nItem="x"')), "decimal": invoice(det=det('nItem="5.7"')),
        "blank_number": invoice(det=det('nItem=" "')), "second": invoice(det=det() + det('nItem="x"')),
    },
    "invalid_encoding": {
        "utf8": invoice(ide="<nNF>é</nNF>").encode("latin-1"),
        "not_ascii": ('<?xml version="1.0" encoding="ascii"?>' + invoice(ide="<nNF>é</nNF>")).encode(),
        "odd_utf16": invoice().encode("utf-16") + b"x",
        "high_half": invoice(ide="<nNF>\ud83d</nNF>").encode("utf-16", "surrogatepass"),
        "low_half": b"\xfe\xff" + invoice(ide="<nNF>\ude00</nNF>").encode("utf-16-be", "surrogatepass"),
    },
    "unsupported_encoding": {
        "not_utf16": b'<?xml version="1.0" encoding="UTF-16"?><a/>',
        "ebcdic": b'<?xml version="1.0" encoding="cp500"?><a/>',
    },
}


def test_unreadable_files(parse):
    expected = {name: error for error, docs in BAD.items() for name in docs}
    rows = parse({name: text for docs in BAD.values() for name, text in docs.items()})
    assert {name: r.error for name, r in rows.items()} == expected
    assert all(r.document is None for r in rows.values())


def test_session_settings_do_not_matter(spark, parse):
    documents = {k: v for docs in (GOOD, *BAD.values()) for k, v in docs.items()}
    expected = parse(documents)
    changed = {
        "spark.sql.ansi.enabled": "false", "spark.sql.session.timeZone": "America/Sao_Paulo",
        "spark.sql.adaptive.enabled": "false", "spark.sql.codegen.wholeStage": "false",
    }
    before = {name: spark.conf.get(name) for name in changed}
    try:
        for name, value in changed.items():
            spark.conf.set(name, value)
        assert repr(parse(documents)) == repr(expected)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
