import __spark_entry__ as E


def test_contract_keys(spark):
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 40


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["wind_bucket", "precip_bucket", "visib_bucket", "flights", "delay_rate",
                          "cancellation_rate"]
    assert len(rows) > 0
