"""Invented people, and the five messages of each."""

import json

SURNAMES = "Abel Boro Cano Dahl Egger Fine Gold Horn Iver Jura".split()


def people():
    return [
        {
            "_id": f"T-{i:03d}",
            "name": f"Ann{i}",
            "last_name": surname,
            "sex": ["F" if i % 2 else "M"],
            "telfnumber": f"555-{i:04d}",
            "email": f"ann{i}@example.org",
            "fullname": f"Ann{i} {surname}",
            "city": f"City {i}",
            "address": f"{i} Long Road",
            "IPv4": f"198.51.100.{i}",
            "IBAN": f"TT{i:010d}",
            "salary": f"{1000 + i}$",
            "company": f"Works {i}",
            "company address": f"{i} Yard",
            "company_telfnumber": f"556-{i:04d}",
            "company_email": f"w{i}@example.org",
            "job": f"Job {i}",
        }
        for i, surname in enumerate(SURNAMES)
    ]


PARTS = (
    ("passport", "name", "last_name", "sex", "telfnumber", "email"),
    ("passport", "IBAN", "salary"),
    ("fullname", "city", "address"),
    ("address", "IPv4"),
    (
        "fullname",
        "company",
        "company address",
        "company_telfnumber",
        "company_email",
        "job",
    ),
)


def messages():
    """50 JSON texts."""
    out = []
    for person in people():
        record = {**person, "passport": person["_id"]}
        out += [json.dumps({k: record[k] for k in keys}) for keys in PARTS]
    return out


def feed(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "seq bigint, data string")


def bronze(spark, texts, start=0, when="2024-01-01 00:00:00", topic="people"):
    """Bronze rows of the given JSON texts."""
    rows = [(topic, 0, start + i, None, None, t) for i, t in enumerate(texts)]
    flat = spark.createDataFrame(
        rows, "topic string, partition int, offset bigint, timestamp bigint, key string, data string"
    )
    return flat.selectExpr(
        "struct(topic, partition, offset, timestamp, key) AS kafka_metadata",
        "data",
        f"TIMESTAMP '{when}' AS inserted_at",
    )
