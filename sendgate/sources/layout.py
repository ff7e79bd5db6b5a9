"""Folder layout of the staged tables: one folder per day, business and transaction."""

from __future__ import annotations

import datetime as dt
from urllib.parse import quote


def day_folder(root: str, run_date: dt.date) -> str:
    return f"{root.rstrip('/')}/run_date={run_date.isoformat()}"


def run_folder(root: str, run_date: dt.date, business: str, transaction_id: str) -> str:
    """The folder one run owns; writing it again replaces it and nothing else."""
    for label, value in (("business", business), ("transaction_id", transaction_id)):
        if not value:
            raise ValueError(f"empty {label}")
    return (
        f"{day_folder(root, run_date)}/business={quote(business, safe='')}"
        f"/transaction_id={quote(transaction_id, safe='')}"
    )
