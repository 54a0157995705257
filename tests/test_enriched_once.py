from haulyard.catalog.queries import QUERIES


def test_enriched_bookings_come_from_stored_rows(spark, data):
    """The feed's joins and the choice of first rows ran once; what is left joins the weather only."""
    enriched = QUERIES["bookings_enriched"](spark, data)
    files = enriched.inputFiles()
    assert files and not any(name in f for f in files for name in ("lineitem", "orders", "customer"))
    assert "Window" not in enriched._jdf.queryExecution().optimizedPlan().toString()
