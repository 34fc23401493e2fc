def local_dir(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path
