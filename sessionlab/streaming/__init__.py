from sessionlab.streaming.incremental import (  # noqa: F401
    batch_partials, merge_partials_exact, open_sessions, run_incremental, run_windowed, windowed_sessions,
)
