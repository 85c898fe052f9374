"""Structured Streaming: the prediction cycle (state machine and windowed),
nutrient scoring, and retraining from completed rows."""
