"""Small hand-written banking landing drop (the shapes of FIXTURES.md §1)."""

import json
import os

STAMP = "20260701"


def write_drop(landing: str, *, n_customers: int = 20, n_accounts: int = 30, n_txns: int = 200,
               extra_txns: list[dict] | None = None, stamp: str = STAMP, fx: dict | None = None) -> str:
    os.makedirs(landing, exist_ok=True)
    segs = ["retail", "premium", "business"]
    risks = ["low", "medium", "high"]
    with open(os.path.join(landing, f"customers_{stamp}.csv"), "w", encoding="utf-8") as fh:
        fh.write("customer_id,full_name,doc_id,birth_date,city,segment,risk_rating,created_at\n")
        for i in range(1, n_customers + 1):
            name = f"  Name {i}\t" if i == 1 else f"Name {i}"
            seg = segs[i % 3].upper() if i == 2 else segs[i % 3]
            fh.write(f"CUST-{i:05d},{name},{1000000 + i},19{50 + i % 40}-0{1 + i % 9}-1{i % 9},"
                     f"La Paz,{seg},{risks[i % 3]},2020-01-{1 + i % 28:02d}\n")
    with open(os.path.join(landing, f"accounts_{stamp}.csv"), "w", encoding="utf-8") as fh:
        fh.write("account_id,customer_id,account_type,currency,opened_at,status\n")
        for i in range(1, n_accounts + 1):
            cust = 1 + (i - 1) % n_customers
            fh.write(f"ACC-{i:06d},CUST-{cust:05d},{'checking' if i % 2 else 'savings'},"
                     f"{'BOB' if i % 3 else 'USD'},2021-03-{1 + i % 28:02d},active\n")
    channels = ["ATM", "POS", "web", "branch"]
    with open(os.path.join(landing, f"transactions_{stamp}.jsonl"), "w", encoding="utf-8") as fh:
        for i in range(1, n_txns + 1):
            day = "2026-06-29" if i % 40 == 0 else "2026-07-01"
            rec = {"txn_id": f"TXN-{stamp}-{i:06d}", "account_id": f"ACC-{1 + i % n_accounts:06d}",
                   "ts": f"{day}T{8 + i % 10:02d}:{i % 60:02d}:00", "amount": round(10 + i * 1.37, 2),
                   "currency": "USD" if i % 5 == 0 else "BOB", "txn_type": "payment",
                   "channel": channels[i % 4], "counterparty": f"shop {i % 7}",
                   "merchant_category": "grocery", "is_flagged": i == 1}
            fh.write(json.dumps(rec) + "\n")
        for rec in extra_txns or []:
            fh.write(json.dumps(rec) + "\n")
    with open(os.path.join(landing, f"fx_rates_{stamp}.json"), "w", encoding="utf-8") as fh:
        json.dump(fx or {"date": "2026-07-01", "base": "BOB",
                         "rates_to_bob": {"BOB": 1.0, "USD": 6.96, "EUR": 7.52}}, fh)
    return landing


def bad_txn(txn_id: str, **kw) -> dict:
    rec = {"txn_id": txn_id, "account_id": "ACC-000001", "ts": "2026-07-01T12:00:00", "amount": 25.0,
           "currency": "BOB", "txn_type": "payment", "channel": "web", "counterparty": "x",
           "merchant_category": "grocery", "is_flagged": False}
    rec.update(kw)
    return rec
