from pyspark.sql import Row

from rentscope.plans.companies import COLUMNS, keep_numeric


def _row(**kw):
    base = dict(nit="1", company_name="X", supervisor="S", region="R", department="D", city="C", ciiu="46",
                macrosector="M", operating_revenue="$100", profit="$1", total_assets="$1",
                total_liabilities="$1", total_equity="$1", cutoff_year="2023")
    base.update(kw)
    return Row(**{c: base[c] for c in COLUMNS})


def test_money_cells(spark):
    cells = ["$100", "100.5", "-5", "1,000", "1e5", "", None]
    rows = [_row(nit=str(i), operating_revenue=v, profit=v) for i, v in enumerate(cells)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in COLUMNS))
    strict = {r.nit: r.operating_revenue for r in keep_numeric(df, "drop").collect()}
    assert strict == {0: 100.0, 1: 100.5}  # sign not allowed on revenue; junk rows dropped
    lenient = {r.nit: (r.operating_revenue, r.profit) for r in keep_numeric(df, "null").collect()}
    assert lenient == {0: (100.0, 100.0), 1: (100.5, 100.5), 2: (-5.0, -5.0), 3: (None, None),
                       4: (None, None), 5: (None, None), 6: (None, None)}
    # sign allowed on profit in the strict form
    df2 = spark.createDataFrame([_row(profit="-5", total_equity="$-7.25")], ", ".join(f"{c} string" for c in COLUMNS))
    r = keep_numeric(df2, "drop").first()
    assert (r.profit, r.total_equity) == (-5.0, -7.25)
