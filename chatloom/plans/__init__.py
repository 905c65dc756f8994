"""Every operator as a query over the given tables, with its SQL counterpart."""

from chatloom.plans import (  # noqa: F401
    batching,
    chats,
    logs,
    objectives,
    preference,
    rewards,
    sources,
    tokens,
)
from chatloom.plans.common import ORACLE, QUERIES  # noqa: F401
