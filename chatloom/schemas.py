"""Declared input schemas: no inference pass over a corpus, ever."""

from pyspark.sql import types as T

MESSAGE = T.StructType(
    [
        T.StructField(f, T.StringType())
        for f in ("role", "content", "reasoning_content", "tools", "tool_calls")
    ]
)
CONVERSATION = T.ArrayType(MESSAGE)
PLAIN_CONVERSATION = T.ArrayType(
    T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
)

PRETRAIN = T.StructType([T.StructField("text", T.StringType())])
SFT = T.StructType([T.StructField("conversations", CONVERSATION)])
PREFERENCE = T.StructType(
    [T.StructField("chosen", PLAIN_CONVERSATION), T.StructField("rejected", PLAIN_CONVERSATION)]
)
RL_PROMPT = SFT
AGENT_TASK = T.StructType(
    [T.StructField("conversations", CONVERSATION), T.StructField("gt", T.ArrayType(T.StringType()))]
)

# Tables that come from elsewhere: rollouts and scores from inference, headers and
# lines from training runs.
_LONG, _INT, _TEXT, _REAL = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType()
_INTS, _REALS = T.ArrayType(_INT), T.ArrayType(_REAL)


def _table(**fields) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


ROLLOUT = _table(
    prompt_id=_LONG,
    gen_id=_INT,
    batch_id=_LONG,
    completion=_TEXT,
    ids=_INTS,
    new_logps=_REALS,
    old_logps=_REALS,
    ref_logps=_REALS,
    prompt_len=_INT,
)
AGENT_TURN = _table(
    prompt_id=_LONG, gen_id=_INT, turn=_INT, part=_TEXT, ids=_INTS, logps=_REALS
)
MODEL_SCORE = _table(prompt_id=_LONG, gen_id=_INT, part=_TEXT, score=_REAL)
CHECKPOINT = _table(run=_TEXT, epoch=_INT, step=_LONG, world_size=_INT)
LOG_LINE = _table(run=_TEXT, offset=_LONG, arrived=T.TimestampType(), line=_TEXT)
SCORE_CARD = _table(model=_TEXT, subset=_TEXT, accuracy=_REAL)
