select user_id, event_id, kind, value, cast(from_unixtime(at_ms/1000) as timestamp_ntz) as happened_at
from table;
