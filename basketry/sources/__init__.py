"""File sources and sinks of the pipelines."""
