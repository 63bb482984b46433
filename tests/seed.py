"""Small hand-made tables with a fixed clock."""

from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal

from cardwarden.sources import tables as sources
from cardwarden.sources.schemas import TABLES

T = datetime(2026, 4, 1, 12, 0, 0)

# Places as (latitude, longitude).
SHREVEPORT = ("32.52520000", "-93.75020000")
NEW_YORK = ("40.71280000", "-74.00600000")
DALLAS = ("32.77670000", "-96.79700000")
HOUSTON = ("29.76040000", "-95.36980000")
MOSCOW = ("55.75580000", "37.61730000")
TOKYO = ("35.68950000", "139.69171000")
SYDNEY = ("-33.86850000", "151.20930000")

USERS = [
    (1, "John", "Doe", "low", "active"),
    (2, "Sarah", "Connor", "low", "active"),
    (3, "Alice", "Smith", "medium", "active"),
    (4, "David", "Nguyen", "medium", "suspended"),
    (5, "Michael", "Brown", "high", "active"),
    (6, "Olga", "Petrov", "high", "active"),
]
MERCHANTS = [
    (1, "Bookshop", "5942", "0.20", False, 2),
    (2, "Grocery", "5411", "0.10", False, 1),
    (3, "Coin exchange", "6051", "0.85", False, 15),
    (4, "Dark shop", "5999", "0.95", True, 50),
    (5, "Casino", "7995", "0.90", False, 30),
    (6, "Wire hub", "4829", "0.75", False, 10),
    (7, "Department store", "5311", "0.15", False, 0),
    (8, "Coffee bar", "5812", "0.05", False, 0),
]


def payment(number, card, merchant, user, amount, minutes, place=None, mcc="5411",
            status="completed", seconds=0, country="US"):
    """A payment at T plus minutes and seconds."""
    lat, lon = place or (None, None)
    return {
        "transaction_id": number, "card_id": card, "merchant_id": merchant, "user_id": user,
        "transaction_amount": Decimal(str(amount)), "currency_code": "USD",
        "transaction_timestamp": T + timedelta(minutes=minutes, seconds=seconds),
        "merchant_country": country, "customer_country": "US", "merchant_mcc": mcc,
        "transaction_status": status, "is_online": True, "device_id": None, "ip_address": "10.0.0.5",
        "latitude": Decimal(lat) if lat else None, "longitude": Decimal(lon) if lon else None,
    }


PAYMENTS = [
    payment(1, 1, 1, 1, "120.50", -200, SHREVEPORT, "5942"),
    payment(2, 2, 7, 2, "75.00", -200, NEW_YORK, "5311"),
    payment(3, 3, 8, 3, "15.00", -200, DALLAS, "5812"),
    payment(4, 3, 2, 3, "210.00", -199, DALLAS),
    payment(5, 5, 2, 5, "350.00", -5, HOUSTON),
    payment(6, 5, 4, 5, "4800.00", -3, MOSCOW, "5999", country="RU"),
    *[
        payment(7 + i, 6, 6, 6, amount, -50 + 10 * i, MOSCOW, "4829")
        for i, amount in enumerate(["2950.00", "2980.00", "2940.00", "2970.00", "2960.00"])
    ],
]


def rows(spark, table, records):
    schema = TABLES[table].schema
    complete = [tuple(r.get(f.name) for f in schema) for r in records]
    nullable = type(schema)([type(f)(f.name, f.dataType, True) for f in schema])
    return spark.createDataFrame(complete, nullable)


def payments(spark, *records):
    return rows(spark, "transactions", list(records))


def tables(spark):
    users = [
        {"user_id": u, "first_name": f, "last_name": l, "email": f"{f}.{l}@example.com".lower(),
         "risk_profile": r, "account_status": s, "country_iso_code": "US"}
        for u, f, l, r, s in USERS
    ]
    cards = [
        {"card_id": u, "user_id": u, "card_type": "credit", "card_number_hash": f"h{u}",
         "daily_limit": Decimal(5000)}
        for u, *_ in USERS
    ]
    merchants = [
        {"merchant_id": m, "merchant_name": n, "merchant_category_code": c,
         "mcc_description": n, "risk_score": Decimal(r), "is_blacklisted": b,
         "fraud_report_count": k, "country_iso_code": "US"}
        for m, n, c, r, b, k in MERCHANTS
    ]
    built = {
        "users": ("users", users),
        "cards": ("cards", cards),
        "merchants": ("merchants", merchants),
        "transactions": ("transactions", PAYMENTS),
        "alerts": ("alerts", []),
        "audit": ("transaction_audit_log", []),
    }
    return {
        name: sources.fill_defaults(rows(spark, table, records), table, T)
        for name, (table, records) in built.items()
    }
