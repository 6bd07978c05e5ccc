"""The jobs: every public function maps DataFrames to DataFrames."""
