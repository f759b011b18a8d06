from gradmill.sources.collections import from_rows, text_lines
from gradmill.sources.idx import read_idx, read_idx_folder
from gradmill.sources.images import image_data, image_folder, image_sequence, named_images
from gradmill.sources.json_strings import read_json_strings
from gradmill.sources.text import class_list, label_lines

__all__ = [
    "class_list", "from_rows", "image_data", "image_folder", "image_sequence",
    "label_lines", "named_images", "read_idx",
    "read_idx_folder", "read_json_strings", "text_lines",
]
