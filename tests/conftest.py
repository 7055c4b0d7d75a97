import pytest

from skyledger.session import local_session, scratch_path
from skyledger.sinks.tables import Warehouse, create_namespace

EDGE_CSV = """\
time,temperature_2m_max,temperature_2m_min,temperature_2m_mean,precipitation_sum,rain_sum,snowfall_sum,wind_speed_10m_max,city,latitude,longitude
2024-01-01,29.99,0.01,15.0,1.0,1.0,0.0,40.0,Austin,30.2672,-97.7431
2024-01-02,30.0,0.0,15.0,1.01,1.01,0.0,40.01,Austin,30.2672,-97.7431
2024-01-03,35.0,20.0,27.5,20.0,20.0,0.0,10.0,Austin,30.2672,-97.7431
2024-01-04,40.0,-10.0,15.0,50.0,50.0,0.0,60.0,Austin,30.2672,-97.7431
2024-01-05,,,,,,,,Austin,30.2672,-97.7431
,10.0,5.0,7.0,0.0,0.0,0.0,5.0,Austin,30.2672,-97.7431
2024-02-01,10.0,5.0,7.0,0.0,0.0,0.0,5.0,,40.7128,-74.006
2024-02-29,5.555,1.111,3.333,0.0,0.0,0.0,12.344,New York,40.7128,-74.006
"""


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = {
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.maxMetadataStringLength": "10000",  # whole filters in plan texts
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    }
    return local_session(8, **shared)


@pytest.fixture
def edge_file(tmp_path):
    path = tmp_path / "edge.csv"
    path.write_text(EDGE_CSV)
    return path


@pytest.fixture
def raw(spark, edge_file):
    from skyledger.sources.csv import read_raw

    return read_raw(spark, str(edge_file))


@pytest.fixture
def silver(raw):
    from skyledger.operators.layers import to_bronze, to_silver

    return to_silver(to_bronze(raw))


@pytest.fixture
def wh(spark):
    place = scratch_path(spark, "warehouse")
    warehouse = Warehouse("test_" + place.rsplit("-", 1)[1], place)
    create_namespace(spark, warehouse)
    return warehouse


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples, for comparisons that ignore order."""

    def collect(df, *columns):
        found = (df.select(*columns) if columns else df).collect()
        return sorted((tuple(r) for r in found), key=repr)

    return collect
