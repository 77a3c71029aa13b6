from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

NS = "http://www.portalfiscal.inf.br/nfe"


@pytest.fixture(scope="session")
def spark():
    home = tempfile.mkdtemp(prefix="invoicelake-test-")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("invoicelake-tests")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{home}/warehouse")
        .config("spark.checkpoint.dir", f"{home}/checkpoints")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def invoice(
    ide="<nNF>1</nNF>", emit="", dest="", det="", total="", key="<chNFe>K1</chNFe>",
    id_='Id="NFeK1"', protocol="", extra="",
):
    """A small invoice document; every part can be replaced."""
    prot = f"<protNFe><infProt>{key}{protocol}</infProt></protNFe>" if key is not None else ""
    return (
        f'<nfeProc xmlns="{NS}"><NFe><infNFe {id_}><ide>{ide}</ide>{emit}{dest}{det}{total}'
        f"{extra}</infNFe></NFe>{prot}</nfeProc>"
    )


@pytest.fixture(scope="session")
def parse(spark):
    """Parse {name: text or bytes} in one job; returns {name: row of (error, document)}."""
    from invoicelake.operators.xml_parse import parse_invoices

    def run(documents, now="timestamp'2024-05-06 07:08:09.5Z'", sections=None):
        rows = [
            (f"file:/in/{name}", text.encode() if isinstance(text, str) else text)
            for name, text in documents.items()
        ]
        files = spark.createDataFrame(rows, "path string, content binary")
        return {row.source_file: row for row in parse_invoices(files, now, sections).collect()}

    return run
