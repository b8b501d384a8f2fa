from .counts import latest_snapshot, read_documents_stream, read_posts_stream, running_counts, start_counts

__all__ = ["latest_snapshot", "read_documents_stream", "read_posts_stream", "running_counts", "start_counts"]
