from loanweft.streaming.labeling import count_new_files, current_counts, label_new_files

__all__ = ["count_new_files", "current_counts", "label_new_files"]
