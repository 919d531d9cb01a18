"""Sources: travel catalogues, stored API payloads and message streams."""
