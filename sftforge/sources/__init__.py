"""Sources and sinks: conversation JSONL, task records, parquet tables."""

from sftforge.sources.conversations import (
    CONVERSATION_TYPE, fold_turns, last_file_of, messages_of, number_lines, parse_conversation, read_conversations,
    read_lines, write_conversations,
)
from sftforge.sources.tables import table
from sftforge.sources.tasks import TASK_TYPE, parse_task, read_tasks, task_json, write_tasks

__all__ = [
    "CONVERSATION_TYPE", "fold_turns", "last_file_of", "messages_of", "number_lines", "parse_conversation",
    "read_conversations", "read_lines", "write_conversations", "table", "TASK_TYPE", "parse_task", "read_tasks",
    "task_json", "write_tasks",
]
