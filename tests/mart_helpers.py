"""Small builders that several mart tests share."""

from datetime import date


def months(n, year=2020):
    return [date(year + i // 12, i % 12 + 1, 1) for i in range(n)]
