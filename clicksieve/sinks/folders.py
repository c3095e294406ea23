"""Folders of tables, through Hadoop's file system: names and renames, no contents."""


def table_location(spark, table):
    """``(location, provider)`` of a catalog table."""
    rows = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name IN ('Location', 'Provider')").collect()
    found = {r["col_name"]: r["data_type"] for r in rows}
    return found["Location"], found["Provider"]


# What a partition's value cannot have in its folder's name, beside control characters.
ESCAPED = "\"#%'*/:=?\\\x7f{[]^"


def escaped(value):
    """A partition's value as it stands in its folder's name."""
    return "".join(f"%{ord(c):02X}" if c in ESCAPED or ord(c) < 32 else c for c in value)


def _path(spark, path):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def folders(spark, path):
    """Names of the folders right under ``path`` (none if it is not there), in order."""
    root, system = _path(spark, path)
    if not system.exists(root):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(root) if s.isDirectory())


def files(spark, path):
    """Paths of the data files right under ``path``, in order of their names."""
    root, system = _path(spark, path)
    found = [s.getPath() for s in system.listStatus(root) if s.isFile()]
    return sorted(str(p) for p in found if not p.getName().startswith(("_", ".")))


def changed_at(spark, path):
    """When a file or folder changed last, in milliseconds."""
    found, system = _path(spark, path)
    return system.getFileStatus(found).getModificationTime()


def date_file(spark, path, millis):
    found, system = _path(spark, path)
    system.setTimes(found, millis, -1)


def move_folder(spark, source, target):
    """Renames a folder in one step; ``False`` if ``target`` is there already."""
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_path(spark, target)[0].toUri(), spark._jsc.hadoopConfiguration())
    # Unlike FileSystem.rename, this never moves into a folder that exists.
    options = spark._sc._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(_path(spark, source)[0], _path(spark, target)[0], options)
    except Exception as error:
        if "FileAlreadyExists" in str(error):
            return False
        raise
    return True


def drop_folder(spark, path):
    found, system = _path(spark, path)
    system.delete(found, True)
