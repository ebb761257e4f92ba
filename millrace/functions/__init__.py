from millrace.functions.metrics import Metric, rnd, summarise  # noqa: F401
from millrace.functions.scalars import band, bin_to, elapsed_seconds, epoch_ts, label  # noqa: F401
