"""Engagement analytics over cumulative counter snapshots, written as Spark jobs.

Every public function takes DataFrames (plus an explicit ``as_of`` date where
time matters) and returns a DataFrame; nothing reads the wall clock.
"""
