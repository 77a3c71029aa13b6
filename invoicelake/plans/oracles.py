"""The registered queries as SQL over the base tables, independent of the Spark code."""

from __future__ import annotations

from invoicelake.plans.queries import SOURCE_LIMIT
from invoicelake.sources.star_schema import LINES_PER_INVOICE, TOPIC

# One row for each invoice: an order continues on further ones when one does not hold its lines.
_INVOICES = f"""
    invoices AS (
        SELECT orders.*, unnest(range(CAST(greatest(1, ceil(coalesce(n, 0) / {LINES_PER_INVOICE}.0)) AS BIGINT)))
                   AS invoice
        FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey)
        ON o_orderkey = l_orderkey
    )"""

_PRICE = "CAST(l_extendedprice AS DECIMAL(18,2))"
_TAX = f"round({_PRICE} * CAST(l_tax AS DECIMAL(6,4)), 2)"
_DISCOUNT = f"round({_PRICE} * CAST(l_discount AS DECIMAL(6,4)), 2)"

_LINE_TOTALS = f"""
    line_totals AS (
        SELECT l_orderkey, min(l_suppkey) AS suppkey,
               CAST(sum({_PRICE}) AS DOUBLE) AS sum_price,
               CAST(sum({_TAX}) AS DOUBLE) AS sum_tax,
               CAST(sum({_DISCOUNT}) AS DOUBLE) AS sum_discount
        FROM lineitem GROUP BY l_orderkey
    )"""

_RECIPIENT = """
    LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey"""

_ISSUER = """
    LEFT JOIN line_totals ON o_orderkey = l_orderkey
    LEFT JOIN supplier ON suppkey = s_suppkey
    LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey"""

_KEY = "CAST(o_orderkey AS VARCHAR)"
_FILE = f"'nfe_' || {_KEY} || '.xml'"


def _first(value: str) -> str:
    """Totals of an order stand on its first invoice."""
    return f"CASE WHEN invoice = 0 THEN {value} END"


def _sum(column: str) -> str:
    """Exact sum; all amounts and quantities of the tables have at most two decimal places."""
    return f"CAST(sum(CAST({column} AS DECIMAL(18,2))) AS DOUBLE)"


def _header(protocol: str = "TRUE") -> str:
    """Columns of an invoice row; the protocol's are null unless `protocol` holds."""
    return f"""
    {_KEY} AS chave_nfe, {_FILE} AS source_file,
    {_KEY} AS numero_nota, '1' AS serie,
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '-03:00' AS data_emissao,
    CAST(NULL AS VARCHAR) AS data_saida_entrada,
    o_orderpriority AS natureza_operacao, o_orderstatus AS tipo_nota, '1' AS finalidade,
    lpad(CAST(s_suppkey AS VARCHAR), 14, '0') AS emit_documento,
    CASE WHEN s_suppkey IS NOT NULL THEN 'CNPJ' END AS emit_tipo_documento,
    s_name AS emit_nome, CAST(NULL AS VARCHAR) AS emit_fantasia,
    CAST(NULL AS VARCHAR) AS emit_municipio, sn.n_name AS emit_uf,
    lpad(CAST(c_custkey AS VARCHAR), 11, '0') AS dest_documento,
    CASE WHEN c_custkey IS NOT NULL THEN 'CPF' END AS dest_tipo_documento,
    c_name AS dest_nome, c_mktsegment AS dest_municipio, cn.n_name AS dest_uf,
    CAST(NULL AS VARCHAR) AS dest_email,
    {_first('sum_price')} AS valor_produtos, {_first('o_totalprice')} AS valor_nota,
    {_first('sum_tax')} AS valor_total_tributos, {_first('sum_discount')} AS valor_desconto, CAST(0 AS DOUBLE) AS valor_frete,
    CASE WHEN {protocol} THEN lpad({_KEY}, 15, '0') END AS numero_protocolo,
    CASE WHEN {protocol} THEN '100' END AS status_codigo,
    CASE WHEN {protocol} THEN 'Autorizado' END AS status_motivo,
    CAST(NULL AS VARCHAR) AS data_recebimento"""


_ITEM = f"""
    {_KEY} AS chave_nfe, {_FILE} AS source_file,
    l_linenumber AS n_item, CAST(l_partkey AS VARCHAR) AS codigo_produto,
    p_name AS descricao_produto, lpad(CAST(l_partkey AS VARCHAR), 8, '0') AS ncm,
    '5102' AS cfop, 'UN' AS unidade_comercial,
    l_quantity AS quantidade_comercial, p_retailprice AS valor_unitario_comercial,
    l_extendedprice AS valor_produto, CAST({_DISCOUNT} AS DOUBLE) AS valor_desconto,
    CAST({_TAX} AS DOUBLE) AS valor_total_tributos_item"""

_LINES = "FROM orders JOIN lineitem ON o_orderkey = l_orderkey LEFT JOIN part ON l_partkey = p_partkey"

_DAMAGE = f"""
    SELECT 'orders/' || {_FILE} AS path, {_FILE} AS source_file,
           CASE o_orderpriority
               WHEN '1-URGENT' THEN 'malformed_xml'
               WHEN '2-HIGH' THEN 'malformed_xml'
               WHEN '3-MEDIUM' THEN
                   CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem) THEN 'invalid_item_number' END
               WHEN '4-NOT SPECIFIED' THEN 'malformed_xml'
           END AS error
    FROM invoices"""


def _ranking(column: str, total: str) -> str:
    return f"""
        SELECT CAST(l_partkey AS VARCHAR) AS codigo_produto, p_name AS descricao_produto,
               {_sum(column)} AS {total}
        {_LINES}
        GROUP BY 1, 2
        ORDER BY {total} DESC NULLS LAST, codigo_produto, descricao_produto
        LIMIT 10"""


def oracle_sql() -> dict[str, str]:
    return {name: _with_invoices(sql) for name, sql in _sql().items()}


def _with_invoices(sql: str) -> str:
    """The query after the invoices, which most queries are about."""
    sql = sql.strip()
    rest = f", {sql.removeprefix('WITH ')}" if sql.startswith("WITH ") else f"\n{sql}"
    return f"WITH {_INVOICES.strip()}{rest}"


def _sql() -> dict[str, str]:
    return {
        "source_limit": f"""
            SELECT 'orders/' || {_FILE} AS path, {_KEY} AS chave_nfe,
                   strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '-03:00' AS data_emissao
            FROM invoices ORDER BY path LIMIT {SOURCE_LIMIT}""",
        "publish_messages": f"""
            WITH {_LINE_TOTALS}
            SELECT {_KEY} AS message_key, {_header()} FROM invoices {_RECIPIENT} {_ISSUER}""",
        "bronze_messages": """
            SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS partition,
                   event_id AS "offset", ts AS kafka_timestamp,
                   CAST(user_id AS VARCHAR) AS message_key, props AS payload_json
            FROM events""",
        "json_parse": """
            SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""",
        "json_parse_malformed": f"""
            SELECT {_KEY} AS message_key,
                   CASE WHEN o_orderpriority <> '2-HIGH' THEN {_KEY} END AS chave_nfe,
                   CASE WHEN o_orderpriority <> '2-HIGH' THEN cn.n_name END AS dest_uf,
                   CASE WHEN o_orderpriority NOT IN ('2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED')
                        THEN {_first('o_totalprice')} END AS valor_nota,
                   CASE WHEN o_orderpriority NOT IN ('2-HIGH', '3-MEDIUM')
                        THEN CAST(0 AS DOUBLE) END AS valor_frete
            FROM invoices {_RECIPIENT}
            WHERE o_orderpriority <> '1-URGENT'""",
        "silver_header": f"""
            WITH {_LINE_TOTALS}
            SELECT {_header()}, '{TOPIC}' AS topic FROM invoices {_RECIPIENT} {_ISSUER}""",
        "silver_item": f"""
            SELECT {_ITEM}, '{TOPIC}' AS topic {_LINES}""",
        "gold_por_emitente": f"""
            WITH {_LINE_TOTALS}
            SELECT lpad(CAST(s_suppkey AS VARCHAR), 14, '0') AS emit_documento, s_name AS emit_nome,
                   count(*) AS qtd_notas, {_sum(_first('o_totalprice'))} AS valor_total_notas,
                   {_sum(_first('sum_price'))} AS valor_total_produtos,
                   {_sum(_first('sum_tax'))} AS valor_total_tributos
            FROM invoices {_ISSUER} GROUP BY 1, 2""",
        "gold_por_uf_destino": f"""
            SELECT cn.n_name AS dest_uf, count(*) AS qtd_notas,
                   {_sum(_first('o_totalprice'))} AS valor_total_notas
            FROM invoices {_RECIPIENT} GROUP BY 1""",
        "gold_top_produtos_valor": _ranking("l_extendedprice", "valor_total"),
        "gold_top_produtos_quantidade": _ranking("l_quantity", "quantidade_total"),
        "analytics_tributos_emitente": f"""
            WITH {_LINE_TOTALS}
            SELECT lpad(CAST(s_suppkey AS VARCHAR), 14, '0') AS emit_documento, s_name AS emit_nome,
                   {_sum(_first('sum_tax'))} AS total_tributos
            FROM invoices {_ISSUER} GROUP BY 1, 2""",
        "xml_parse_header": f"""
            WITH {_LINE_TOTALS}
            SELECT {_header("o_orderstatus <> 'F'")} FROM invoices {_RECIPIENT} {_ISSUER}""",
        "xml_parse_items": f"SELECT {_ITEM} {_LINES}",
        "xml_document_id": f"""
            SELECT {_FILE} AS source_file,
                   CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH')
                        THEN '777' || lpad(CAST(c_custkey AS VARCHAR), 11, '0')
                        WHEN o_orderpriority = '3-MEDIUM' THEN NULL
                        ELSE lpad(CAST(c_custkey AS VARCHAR), 11, '0') END AS dest_documento,
                   CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'CNPJ'
                        WHEN o_orderpriority = '3-MEDIUM' THEN NULL
                        ELSE 'CPF' END AS dest_tipo_documento
            FROM invoices LEFT JOIN customer ON o_custkey = c_custkey""",
        "xml_access_key": f"""
            SELECT coalesce(chave_nfe, source_file) AS message_key, chave_nfe
            FROM (SELECT {_FILE} AS source_file,
                         CASE o_orderpriority
                             WHEN '3-MEDIUM' THEN '7NFe' || {_KEY}
                             WHEN '4-NOT SPECIFIED' THEN NULL
                             ELSE {_KEY} END AS chave_nfe
                  FROM invoices)""",
        "xml_quarantine": f"SELECT * FROM ({_DAMAGE}) WHERE error IS NOT NULL",
        "ingest_summary": f"""
            SELECT error IS NULL AS success, count(*) AS files FROM ({_DAMAGE}) GROUP BY success""",
        "layer_row_counts": f"""
            SELECT 'bronze_nfe_json' AS layer, count(*) AS row_count FROM invoices
            UNION ALL SELECT 'silver_nfe_header', count(*) FROM invoices
            UNION ALL SELECT 'silver_nfe_item', (SELECT count(*) {_LINES})""",
    }
