"""Fluvion: functions."""
