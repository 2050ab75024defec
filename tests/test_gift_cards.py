"""States and net amounts of gift cards."""

from __future__ import annotations

import datetime as dt

from ledgerloom.plans import gift_cards as G

SHAPE = "card_number string, transaction_date date, event_no long, transaction_type string, amount_cents long, adjustment_cents long, balance_cents long"


def test_the_state_of_a_card(rows):
    d = lambda n: dt.date(2024, 3, n)
    events = rows(SHAPE, [
        ("active", d(1), 1, G.ACTIVATE, 5000, None, None), ("active", d(2), 2, G.REDEEM, -2000, None, None),
        ("back", d(1), 1, G.ACTIVATE, 5000, 100, None), ("back", d(1), 2, G.CANCEL_ACTIVATE, -5000, -100, None),
        ("again", d(3), 3, G.ACTIVATE, 700, None, None), ("again", d(1), 1, G.ACTIVATE, 5000, None, None), ("again", d(2), 2, G.CANCEL_ACTIVATE, -5000, None, None),
        ("new", d(1), 1, G.ACTIVATE, 5000, None, None), ("new", d(2), 2, G.REDEEM, -1000, None, None), ("new", d(3), 3, G.CANCEL_ACTIVATE, -5000, None, None), ("new", d(4), 4, G.REISSUE, None, None, 4000),
        ("spent", d(1), 1, G.ACTIVATE, 5000, None, None), ("spent", d(2), 2, G.REDEEM, -5000, None, None),
        ("undone", d(1), 1, G.ACTIVATE, 5000, None, None), ("undone", d(2), 2, G.REDEEM, -5000, None, None), ("undone", d(2), 3, G.CANCEL_REDEEM, 5000, None, None),
        ("unsold", d(1), 1, G.REDEEM, None, None, None),
    ])
    got = {r["card_number"]: tuple(r)[1:] for r in G.card_states(events).collect()}
    assert got == {
        "active": ("ACTIVE", d(1), 1, 5000, 1, 2000, 0),
        "back": ("CANCELLED", d(1), 0, 0, 0, 0, 0),
        "again": ("ACTIVE", d(3), 1, 700, 0, 0, 0),
        "new": ("REISSUED", d(4), 0, 4000, 1, 1000, 1),
        "spent": ("SPENT", d(1), 1, 5000, 1, 5000, 0),
        "undone": ("ACTIVE", d(1), 1, 5000, 0, 0, 0),
        "unsold": ("UNSOLD", None, 0, 0, 1, 100_000, 0),
    }


def test_a_card_is_not_multiplied_by_its_invoice(rows):
    shape = "card_number string, merchant string, amount_cents long, notes string, invoice_number string, activation_location string, program_group string, design_code string, transaction_date date, transaction_type string"
    events = rows(shape, [("c", "A", 100, "SAP ORD-00000007", "i", "SAP Hybris", "p", "d", dt.date(2024, 3, n), G.ACTIVATE) for n in (1, 2)])
    orders = rows("order_no string, payment_method string, order_date date, b2b_unit string, user_type string, customer_id string, sales_application string, cards long, discount_cents long", [("00000007", "x", None, None, "u", "c", "s", 3, 1000)])
    partner = rows("invoice_number string, discount_cents long", [("i", 50), ("i", 25)])
    got = G.sales_orders(events, orders, partner, {"A": "Own"}, "Other").collect()
    assert len(got) == 1
    r = got[0]
    assert (r["activation_date"], r["sales_outlet"], r["sales_merchant"], r["order_no"]) == (dt.date(2024, 3, 2), "Own", "D2C", "00000007")
    assert abs(r["card_discount"] - (3.333 - 0.75)) < 1e-9
