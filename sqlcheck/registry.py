"""All oracle SQL by query key."""

from . import books, brief, explore, history, lists, matching, order, sales, uploads, weekly

ORACLE: dict[str, str] = {}
for _m in (order, weekly, history, brief, sales, matching, explore, lists, uploads, books):
    ORACLE.update(_m.SQL)
