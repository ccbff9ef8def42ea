from contrail.streaming.jobs import run_scoring, run_traffic, write_scored
from contrail.streaming.scoring import score_stream, split_requests
from contrail.streaming.traffic import request_log, traffic_stream, with_event_time

__all__ = ["request_log", "run_scoring", "run_traffic", "score_stream", "split_requests", "traffic_stream", "with_event_time",
           "write_scored"]
