from lapframe.streaming.counts import running_counts, write_running_counts  # noqa: F401
from lapframe.streaming.dedup import (  # noqa: F401
    dedup_stream,
    insert_if_absent,
    read_batches,
    write_unique,
)
from lapframe.streaming.keytable import KeyTable  # noqa: F401
from lapframe.streaming.live import read_live, read_live_rejects, write_live  # noqa: F401
from lapframe.streaming.metrics import load_metrics, metered_sink  # noqa: F401
from lapframe.streaming.records import (  # noqa: F401
    decode_envelope,
    encode_envelope,
    format_records,
    payload_map,
    read_stream,
    rejected_messages,
    rejected_numbers,
    replay_slice,
    route_by_fields,
    unparseable,
)
from lapframe.streaming.sink import start_sink, write_batches  # noqa: F401
from lapframe.streaming.throttle import (  # noqa: F401
    throttle_batch,
    throttle_per_second,
    write_throttled,
)
