"""marketpulse: market-tick and news-sentiment analytics as Spark DataFrame functions."""

from marketpulse.operators.alerts import alert_outbox, match_alerts, render_alert
from marketpulse.operators.cooldown import Scratch, cooldown
from marketpulse.operators.sentiment import poll_average, score_text, select_articles, sentiment_summary
from marketpulse.operators.snapshot import (at_least, change_board, coins, for_coin, freshness, labels, last_volume,
                                            latest_by_coin, market_share)
from marketpulse.operators.subscriptions import (apply_commands, normalise_command, subs_for, subs_for_email,
                                                 valid_command, with_outcome)
from marketpulse.operators.timeseries import (coin_cards, compare, detail_series, forward_fill, history_panel,
                                              period_stats, resample_ffill, resample_last, sparklines, tight_range)
from marketpulse.sources.codec import (decode, decode_articles, decode_ticks, encode, parse_time, publish,
                                       read_articles, read_ticks, scan_ticks)
from marketpulse.sources.payloads import normalise_articles, normalise_market, restrict
from marketpulse.streaming.jobs import cooldown_stream, resample_stream, sentiment_job, start, tick_job
from marketpulse.streaming.sinks import append_batch, append_summary, compact_date, read_table

__version__ = "0.1.0"
