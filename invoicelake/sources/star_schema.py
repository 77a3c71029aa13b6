"""Orders as invoices: the star-schema tables turned into contract documents.

An order is an invoice, its customer the recipient, its lowest-numbered supplier the issuer and
its lines the invoice lines. The invoice layout allows a limited number of lines; an order with
more continues on further invoices, so no single document grows with the data. All invoices of an order
name its header, issuer, recipient and access key; its totals stand on the first one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from invoicelake import contract
from invoicelake.operators.messages import encode_messages

# Fixed value: the most lines an invoice may hold.
LINES_PER_INVOICE = 990

TOPIC = "orders"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def order_documents(
    spark: SparkSession,
    sf_dir: str,
    sections: tuple[str, ...] | None = None,
    line_totals: bool = True,
    lines_per_invoice: int = LINES_PER_INVOICE,
) -> DataFrame:
    """(source_file, document), one per invoice; the same invoices whatever is read of them.

    Only tables behind the wanted `sections` are read, and of the lines at least the order's key; the
    other sections are missing in the documents. Without `line_totals`, so are the totals that
    need the lines.
    """
    def want(*names: str) -> bool:
        return sections is None or any(name in sections for name in names)

    docs = table(
        spark, sf_dir, "orders",
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderstatus", "o_orderpriority",
    )
    summed = want("emitente") or (want("totais") and line_totals)
    lines = _lines(spark, sf_dir, summed, want("itens"))
    per_order = _per_order(lines, summed)
    parts: dict[str, str] = {}
    if want("destinatario"):
        docs = docs.join(_customers(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"), "left")
        parts["destinatario"] = _RECIPIENT
    if want("emitente"):
        per_order = per_order.join(
            _suppliers(spark, sf_dir), F.col("suppkey") == F.col("s_suppkey"), "left"
        )
        parts["emitente"] = _ISSUER
    # The invoices of an order.
    invoices = F.greatest(F.ceil(F.col("n_lines") / F.lit(lines_per_invoice)), F.lit(1))
    docs = docs.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey")
    if not want("itens"):
        # Writing and reading a document costs far more than moving its row, so the rows are spread
        # by order, which costs nothing where the join was by order. The join with the lines spreads them, too.
        docs = docs.repartition("o_orderkey")
    docs = docs.withColumn(
        "invoice", F.explode(F.sequence(F.lit(0), F.coalesce(invoices, F.lit(1)).cast("int") - 1)))
    if want("itens"):
        goods = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_retailprice")
        collected = _invoice_lines(lines, goods, lines_per_invoice).alias("i")
        of_invoice = (F.col("o_orderkey") == F.col("i.l_orderkey")) & (
            F.col("d.invoice") == F.col("i.invoice"))
        docs = docs.alias("d").join(collected, of_invoice, "left").select("d.*", "i.itens")
        parts["itens"] = "coalesce(itens, array())"
    if want("header"):
        parts["header"] = _HEADER
    if want("totais"):
        parts["totais"] = _TOTALS if summed else _INVOICE_TOTAL
    if want("protocolo"):
        parts["protocolo"] = _PROTOCOL
    return docs.selectExpr(*_document("o_orderkey", parts, sections))


def as_messages(documents: DataFrame) -> DataFrame:
    """Documents as rows of a message log, with fixed times and offsets by key.

    The offset is not needed by any query over these messages and so costs no numbering.
    """
    return encode_messages(documents).select(
        F.lit(TOPIC).alias("topic"),
        F.pmod(F.hash("key"), F.lit(4)).alias("partition"),
        F.xxhash64("key").alias("offset"),
        F.timestamp_seconds(F.lit(0)).alias("timestamp"),
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
    )


def events_as_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a message log."""
    events = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "props")
    return events.select(
        F.col("event_type").alias("topic"),
        F.pmod("user_id", F.lit(4)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.col("props").cast("binary").alias("value"),
    )


def _lines(spark: SparkSession, sf_dir: str, summed: bool, listed: bool) -> DataFrame:
    """Lines of orders with the columns that are read, their scan partition and place in it.

    Both are the same whenever a task over the same files is run again.
    """
    columns = ["l_orderkey"]
    if summed or listed:
        columns += ["l_suppkey", "l_extendedprice", "l_discount", "l_tax"]
    if listed:
        columns += ["l_linenumber", "l_partkey", "l_quantity"]
    return table(spark, sf_dir, "lineitem", *columns).withColumn(
        "scan", F.spark_partition_id()).withColumn("line_id", F.monotonically_increasing_id())


def _per_order(lines: DataFrame, summed: bool) -> DataFrame:
    """Number of lines and their totals for each order."""
    return lines.groupBy("l_orderkey").agg(
        F.count("*").alias("n_lines"), *(_line_totals() if summed else ()))


def _invoice_lines(lines: DataFrame, goods: DataFrame, limit: int) -> DataFrame:
    """(l_orderkey, invoice, itens): lines by their exact number in the order, `limit` on an invoice.

    Only lines of orders with more than `limit` are numbered. These orders are at most one for `limit`
    lines of the table, so their keys are broadcast, and all other lines are shuffled by order once. A
    line of an unknown part has no name and price.
    """
    oversized = F.broadcast(
        _per_order(lines, False).where(F.col("n_lines") > limit).select("l_orderkey"))
    columns = [c for c in lines.columns if c not in ("scan", "line_id")]
    usual = lines.join(oversized, "l_orderkey", "left_anti").select(
        *columns, F.lit(0).cast("long").alias("invoice"))
    numbered = _numbered(lines.join(oversized, "l_orderkey", "left_semi"), limit)
    named = usual.unionByName(numbered.select(*columns, "invoice")).join(
        goods, F.col("l_partkey") == F.col("p_partkey"), "left")
    # Spread by order and invoice, not by order alone, which the joins' partitioning would allow.
    return named.repartition("l_orderkey", "invoice").groupBy("l_orderkey", "invoice").agg(
        F.sort_array(F.collect_list(F.expr(_ITEM))).alias("itens"))


def _numbered(lines: DataFrame, limit: int) -> DataFrame:
    """The lines and their `invoice`.

    A line's number is its place among the order's lines of its scan partition, after all those of earlier
    partitions. So a hot order is spread over as many tasks as partitions hold it,
    and each of its invoices is collected by itself.
    """
    cells = lines.groupBy("l_orderkey", "scan").agg(F.count("*").alias("n_lines"))
    earlier = Window.partitionBy("l_orderkey").orderBy("scan").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = cells.select(
        "l_orderkey", "scan", F.coalesce(F.sum("n_lines").over(earlier), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("l_orderkey", "scan").orderBy("line_id"))
    invoice = F.floor((F.col("before") + F.col("place") - 1) / F.lit(limit))
    return lines.join(starts, ["l_orderkey", "scan"]).withColumn("place", place).withColumn(
        "invoice", invoice)


_CENTS = "CAST(rint(l_extendedprice * 100) AS BIGINT)"


def _share(rate: str) -> str:
    """A line's tax or discount in cents, rounded half up (away from zero)."""
    millionths = f"{_CENTS} * CAST(rint({rate} * 10000) AS BIGINT)"
    return f"(({millionths} + if(l_extendedprice < 0, -5000, 5000)) DIV 10000)"


def _line_totals() -> list[Column]:
    """Totals in cents, so that sums of sums are exact."""
    return [
        F.min("l_suppkey").alias("suppkey"),
        F.expr(f"sum({_CENTS}) AS sum_price"),
        F.expr(f"sum({_share('l_tax')}) AS sum_tax"),
        F.expr(f"sum({_share('l_discount')}) AS sum_discount"),
    ]


_ITEM = f"""struct(
    l_linenumber AS n_item,
    CAST(l_partkey AS STRING) AS codigo_produto,
    p_name AS descricao_produto,
    lpad(CAST(l_partkey AS STRING), 8, '0') AS ncm,
    '5102' AS cfop,
    'UN' AS unidade_comercial,
    l_quantity AS quantidade_comercial,
    p_retailprice AS valor_unitario_comercial,
    l_extendedprice AS valor_produto,
    {_share('l_discount')} / 100 AS valor_desconto,
    {_share('l_tax')} / 100 AS valor_total_tributos_item)"""


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    states = table(spark, sf_dir, "nation", "n_nationkey", F.col("n_name").alias("c_state"))
    return customers.join(states, F.col("c_nationkey") == F.col("n_nationkey"), "left")


def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey")
    states = table(
        spark, sf_dir, "nation",
        F.col("n_nationkey").alias("s_statekey"), F.col("n_name").alias("s_state"),
    )
    return suppliers.join(states, F.col("s_nationkey") == F.col("s_statekey"), "left")


_HEADER = """struct(
    CAST(o_orderkey AS STRING) AS numero_nota,
    '1' AS serie,
    concat(replace(left(CAST(o_orderdate AS STRING), 19), ' ', 'T'), '-03:00') AS data_emissao,
    CAST(NULL AS STRING) AS data_saida_entrada,
    o_orderpriority AS natureza_operacao,
    o_orderstatus AS tipo_nota,
    '1' AS finalidade)"""

_RECIPIENT = """struct(
    lpad(CAST(c_custkey AS STRING), 11, '0') AS documento,
    if(c_custkey IS NOT NULL, 'CPF', NULL) AS tipo_documento,
    c_name AS nome,
    c_mktsegment AS municipio,
    c_state AS uf,
    CAST(NULL AS STRING) AS email)"""

_ISSUER = """struct(
    lpad(CAST(s_suppkey AS STRING), 14, '0') AS documento,
    if(s_suppkey IS NOT NULL, 'CNPJ', NULL) AS tipo_documento,
    s_name AS nome,
    CAST(NULL AS STRING) AS fantasia,
    CAST(NULL AS STRING) AS municipio,
    s_state AS uf)"""

_TOTALS = """struct(
    if(invoice = 0, sum_price / 100, NULL) AS valor_produtos,
    if(invoice = 0, o_totalprice, NULL) AS valor_nota,
    if(invoice = 0, sum_tax / 100, NULL) AS valor_total_tributos,
    if(invoice = 0, sum_discount / 100, NULL) AS valor_desconto,
    0.0D AS valor_frete)"""

_INVOICE_TOTAL = """struct(
    CAST(NULL AS DOUBLE) AS valor_produtos,
    if(invoice = 0, o_totalprice, NULL) AS valor_nota,
    CAST(NULL AS DOUBLE) AS valor_total_tributos,
    CAST(NULL AS DOUBLE) AS valor_desconto,
    0.0D AS valor_frete)"""

_PROTOCOL = """struct(
    lpad(CAST(o_orderkey AS STRING), 15, '0') AS numero_protocolo,
    '100' AS status_codigo,
    'Autorizado' AS status_motivo,
    CAST(NULL AS STRING) AS data_recebimento)"""


def _document(
    key: str, parts: dict[str, str], sections: tuple[str, ...] | None
) -> list[str]:
    """Columns source_file and document, as SQL; sections without a part are missing (null)."""
    source_file = f"concat('nfe_', CAST({key} AS STRING), '.xml')"
    values = {
        "source_file": source_file,
        "ingestion_ts": "'2024-01-01T00:00:00Z'",
        "chave_nfe": f"CAST({key} AS STRING)",
        **parts,
    }
    fields = [
        f"{values.get(f.name, f'CAST(NULL AS {f.dataType.simpleString()})')} AS {f.name}"
        for f in contract.document_schema(sections).fields
    ]
    return [f"{source_file} AS source_file", f"struct({', '.join(fields)}) AS document"]
