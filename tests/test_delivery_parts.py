"""Deliveries are written by as many tasks as they have parts, and read back whole."""

import pytest
from oracle import compare, connect
from pyspark.sql import functions as F

from bazaarline.queries import ORACLES, deliveries
from bazaarline.queries.registry import Feeds

FOLDER = "/root/testdata/sf0.001"


class Spread(Feeds):
    """Products and sales in four parts."""

    def _view(self, name):
        return super()._view(name).repartition(4) if name == "products" else super()._view(name)

    def pos(self):
        return super().pos().repartition(4)


@pytest.mark.parametrize("name, run", [
    ("src01_csv_two_headers", deliveries.two_headers), ("str01_stream_csv_two_headers", deliveries.stream_two_headers),
    ("job03_onboarding", deliveries.onboarding), ("onb08_registry", deliveries.onboarded_registry)])
def test_deliveries_of_many_files(spark, name, run):
    assert compare(spark, connect(FOLDER), name, lambda s, folder: run(Spread(s, folder)), ORACLES[name], FOLDER) == []


def test_no_half_goes_through_one_task(spark):
    files = deliveries.two_headers(Spread(spark, FOLDER)).select(F.input_file_name()).distinct()
    assert files.count() == 8
