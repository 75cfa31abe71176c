"""A small invented set: ten listings, ten reviews, documents of two shapes, six places."""

from datetime import date, datetime, timedelta
from decimal import Decimal

from lakestrata.plans import lodging

_LANDED = (datetime(2025, 1, 1), "TEST_RUN", "loader", "test_feed", "TEST_API")

# prices: five above 200, two above 100, three at most 100; rooms by the kinds that policies know
_PRICES = (410, 260, 150, 90, 75, 120, 60, 305, 215, 500)
_ROOMS = ("Entire home/apt", "Entire home/apt", "Entire home/apt", "Private room", "Private room",
          "Private room", "Shared room", "Entire home/apt", "Private room", "Entire home/apt")
_IDS = [71 + 3 * i for i in range(10)]


def _place(i):
    return f"{48.10205 + 0.01370 * i:.5f}", f"{11.50310 + 0.02110 * i:.5f}"


def landing_listings(spark):
    """The last listing has had no review yet."""
    rows = []
    for i, (id_, price, room) in enumerate(zip(_IDS, _PRICES, _ROOMS)):
        last = None if i == 9 else str(date(2025, 2, 3) + timedelta(days=5 * i))
        rate = None if i == 9 else str(1 + i * 0.25)
        rows.append((*_LANDED, str(id_), f"Lodging No. {i}", str(600 + i), f"Host {i}", f"Quarter {i % 3}", f"Street {i}", *_place(i), room, str(price),
                     "2", str(10 + i), last, rate, "1", "200", "9", f"N{i}"))
    return spark.createDataFrame(rows, lodging.landing_schema(list(lodging.LISTING_TYPES)))


def landing_reviews(spark):
    """Every listing but two has reviews, two have two each."""
    listed = [_IDS[i] for i in (0, 1, 2, 2, 4, 5, 6, 7, 7, 9)]
    rows = [(*_LANDED, str(id_), str(31 + 2 * i), str(date(2025, 3, 1) + timedelta(days=i)), str(801 + i), f"Guest {i}", f'Wrote "good"\nand stayed {i}')
            for i, id_ in enumerate(listed)]
    return spark.createDataFrame(rows, lodging.landing_schema(list(lodging.REVIEW_TYPES)))


DOCUMENTS = [
    '{"SOURCESYSTEM":"F","code":"HAM","dob":"1985-01-07","driverId":1,"driverRef":"ham","name":{"forename":"Lewis","surname":"H"},"nationality":"British","number":44,"url":"u1"}',
    '{"SOURCESYSTEM":"F","code":"ALO","dob":"1981-07-29","driverId":2.5,"driverRef":"alo","name":{"forename":"Fernando","surname":"A"},"nationality":"Spanish","number":14,"url":"u2"}',
    '{"SOURCESYSTEM":"F","code":"XXX","driverId":3,"driverRef":"x","name":{"forename":"No","surname":"Nation"}}',
]
# documents of a shape that the flattening does not know
OTHER_DOCUMENTS = [
    '{"vehicle":"tram","seats":120,"lines":[{"no":16,"stops":31}]}',
    '{"vehicle":"bus","seats":44,"lines":[]}',
]


def landing_drivers(spark, docs=None):
    from pyspark.sql import functions as F

    rows = [(d,) for d in (docs if docs is not None else OTHER_DOCUMENTS)]
    return spark.createDataFrame(rows, "payload string").select(F.parse_json("payload").alias("payload"))


def _places():
    return [(i, Decimal(lat), Decimal(lon)) for i, (lat, lon) in enumerate([_place(i) for i in range(6)], 1)]


def geography(spark):
    rows = [(Decimal(i), Decimal(100 + i), lat, lon, None, "area", "borough", "LONDON", "GB", "N/A") for i, lat, lon in _places()]
    return spark.createDataFrame(rows, lodging.GEOGRAPHY)


def geospatial(spark):
    rows = [(Decimal(i), Decimal(i), Decimal(2000 + i), "place", "text", lat, lon, None, "GB", "LONDON", "N/A") for i, lat, lon in _places()]
    return spark.createDataFrame(rows, lodging.GEOSPATIAL)
