"""Straight-line model of the intent rules for small fixtures: lists, scanned again for every event."""

from collections import defaultdict

HOUR = 3_600_000
DAY = 24 * HOUR
WEEK = 7 * DAY
HOME = ("home_improvement", "furniture", "kitchen_appliances")


def event(event_id, customer, ms, category=None, amount=0.0, kind="txn", card=0, kind_of_txn=None):
    return {
        "event_id": event_id, "customer_id": customer, "event_ts_ms": ms, "kind": kind,
        "merchant_category": category, "amount": amount, "has_credit_card": card,
        "transaction_type": (kind_of_txn or ("salary" if category == "salary" else "debit")) if kind == "txn" else None,
    }


def run(events):
    """All signals and the kept ones, in order, as (customer, product, ms, event_id, metric, session_ms)."""
    signals, kept, spend = [], [], {}
    seen = defaultdict(list)
    session, last_kept = {}, {}
    for e in sorted(events, key=lambda x: (x["event_ts_ms"], x["event_id"])):
        c, now = e["customer_id"], e["event_ts_ms"]
        seen[c].append(e)
        week = [x for x in seen[c] if x["kind"] == "txn" and now - x["event_ts_ms"] <= WEEK]
        found = []
        if e["kind"] == "txn" and e["merchant_category"] in HOME:
            total, start, last = session.get(c) or (0.0, now, now)
            if now - last > WEEK:
                total, start = 0.0, now
            total = round(total + e["amount"], 2)
            session[c] = (total, start, now)
            if total > 2000:
                session[c] = None
                found.append(("home_loan", total, now - start))
        day = [x for x in week if now - x["event_ts_ms"] <= DAY]
        retail = sum(x["merchant_category"] == "retail" for x in day)
        if retail >= 3 and not any(x["has_credit_card"] for x in week):
            found.append(("credit_card", float(retail), None))
        pay = [x for x in week if x["transaction_type"] == "salary" or x["merchant_category"] == "salary"]
        fun = [x for x in week if x["merchant_category"] in ("travel", "electronics")]
        if pay and fun:
            found.append(("personal_loan", float(len(fun)), None))
        for p in pay:
            t = p["event_ts_ms"]
            if p["amount"] >= 5000 and now >= t + 3 * DAY and not any(
                    t < x["event_ts_ms"] <= t + 3 * DAY for x in week):
                found.append(("fixed_deposit", 1.0, None))
                break
        for product, metric, length in found:
            row = (c, product, now, e["event_id"], metric, length)
            signals.append(row)
            before = last_kept.get((c, product))
            if before is None or now - before >= DAY:
                last_kept[(c, product)] = now
                kept.append(row)
                by = defaultdict(float)
                for x in week:
                    by[x["merchant_category"] or "unknown"] += x["amount"]
                spend[(c, e["event_id"])] = {k: round(v, 2) for k, v in by.items()}
    return signals, kept, spend
