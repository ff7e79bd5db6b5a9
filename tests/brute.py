"""Plain Python answers for small inputs."""

from collections import Counter

from sendgate import schemas as S


def overdue_ids(loans):
    return {
        appl for appl, bucket, amount in loans
        if appl is not None and (bucket or 0) > 0 and (amount or 0) > 0
    }


def status_of(due, overdue, history, business, cap=3):
    """due: (appl, imei, code); history: (imei, business) of the day."""
    by_business = {imei for imei, biz in history if biz == business}
    sent = Counter(imei for imei, _ in history)
    labelled = []
    for appl, imei, code in due:
        if imei is None:
            status = S.NULL
        elif appl in overdue:
            status = S.DELINQUENT
        elif imei in by_business:
            status = S.DUPLICATE_BIZ
        elif sent[imei] >= cap:
            status = S.DUPLICATE_GLOBAL
        else:
            status = S.UNIQUE_GLOBAL
        labelled.append((appl, imei, code, status))
    return labelled


def nulls_first(row):
    return tuple((value is not None, value) for value in row)


def numbered(rows, step, per_code=True):
    """(appl, imei, code, row_no, batch_no) for rows (appl, imei, code)."""
    seen = Counter()
    out = []
    for row in sorted(rows, key=nulls_first):
        group = row[2] if per_code else None
        seen[group] += 1
        out.append((*row, seen[group], (seen[group] - 1) // step))
    return out
